import html
import random
import re

import pytest

from docweave.llm import html_extraction as X, html_parts as H
from docweave.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def shape(source):
    return X._shape(H.read_page(source).items)


def texts(source):
    return H.read_page(source).texts


def test_blocks_references_and_white_space():
    assert texts("<p>a &amp; b&nbsp;&lt;i&gt;\n\t c<br>d</p>tail<hr>more") == ["a & b <i> c d", "tail", "more"]
    assert texts("<p>one<b>two<p>three</b> four") == ["onetwo", "three four"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul>d") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>4") == ["1", "2", "3", "4"]
    assert texts("3 < 4 and 5 > 2 <3 &copy &notit; &#65;&#x42;") == ["3 < 4 and 5 > 2 <3 © ¬it; AB"]


def test_what_is_no_text():
    assert texts('<script>var t="</p><p>no";</script><p>a<!-- no <p>no --><style>p{}</style>b') == ["ab"]
    assert texts('<p title="a>b" class=x>t</p><p title=it\'s>u</p>') == ["t", "u"]
    assert texts("<p>a<span class='ad'>no <span>no</span></span>b<button>no</button>c<i hidden>no</i>") == ["abc"]
    assert texts("<p>a<span class=ad>no</p><p>b</p>") == ["a", "b"]
    assert texts("<p>a<script>never closed <p>b") == ["a"]
    assert texts("") == texts("<!-- open <p>x") == texts("<p></p>") == []


def test_repetitions_fold_into_items_and_groups():
    assert shape("<p>a<p>b<p>c") == '[[1,2,"p",[[1,1,"#",null]]]]'
    once = shape("<dl><dt>a<dd>b<dt>c<dd>d</dl>")
    assert once == '[[1,1,"dl",[[1,2,"",[[1,1,"dt",[[1,1,"#",null]]],[1,1,"dd",[[1,1,"#",null]]]]]]]]'
    assert once == shape("<dl>" + "<dt>a<dd>b" * 50 + "</dl>")


def merged(*sources):
    return H.bare(X.reduce(H.merge, [H.filled(X.json.loads(shape(s))) for s in sources]))


def test_mismatches_become_optional_or_repeated():
    leaf = [[1, 1, "#", None]]
    assert merged("<h1>a</h1><p>b", "<h1>a</h1><ul><li>x</ul><p>b") == [
        [1, 1, "h1", leaf], [0, 1, "ul", [[1, 1, "li", leaf]]], [1, 1, "p", leaf],
    ]
    assert merged("<p>a", "<p>a<p>b") == [[1, 2, "p", leaf]]
    assert merged("<h2>a</h2><p>b", "<h2>a</h2><p>b<h2>a</h2><p>b") == [[1, 2, "", [[1, 1, "h2", leaf], [1, 1, "p", leaf]]]]
    assert merged("<div><p>a</div>", "<div><ol><li>a</ol></div>") == [
        [1, 1, "div", [[0, 1, "p", leaf], [0, 1, "ol", [[1, 1, "li", leaf]]]]]
    ]


def test_common_pairs_are_longest():
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            out = [0]
            for j, y in enumerate(b):
                out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
            row = out
        return row[-1]

    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        pairs = H.common_pairs(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
        assert len(pairs) == length(a, b)


def test_a_wrapper_places_all_blocks_of_its_pages():
    sources = [
        "<nav><a>x</a></nav><article><h1>t</h1><p>a<p>b</article>", "<article><h1>t</h1><p>a<ul><li>x<li>y</ul><p>b</article><footer>f</footer>",
        "<div class=x1>n</div><article><h2>a</h2><p>b<h2>c</h2><p>d</article>",
    ]
    wrapper = X.json.dumps(merged(*sources))
    for source in sources:
        page = H.read_page(source)
        assert None not in X._Placed().slots(page, wrapper)


@pytest.mark.parametrize("label,kind", [
    ("nav", X.APART), ("div.side-bar", X.OPEN), ("div.sidebar", X.APART), ("div.no-sidebar", X.OPEN), ("div.readerComments", X.APART),
    ("article", X.ARTICLE), ("div@main", X.MAIN), ("div.blog-post", X.MAIN), ("header", X.APART), ("section@complementary", X.APART),
    ("div.header", X.OPEN), ("p@hidden", X.APART), ("div.shadow", X.OPEN),
])
def test_kinds_of_elements(label, kind):
    assert X._kind(label)[0] == kind


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, shape string")


def _row(i, url, source):
    return (i, url, source, "clash", "clash", "clash")


def test_hosts_without_article_elements_are_judged_by_their_pages(spark):
    rng = random.Random(1)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows, want = [], {}
    for i in range(12):
        body = [words(30) for _ in range(rng.randint(1, 4))]
        title = words(4)
        rows.append(_row(i, f"http://A.example/{i}", f"<div><a href=/>Home</a><a href=/x>{words(2)}</a></div><div class=wrap><h1>{title}</h1><div>"
                         + "".join(f"<p>{b}" for b in body) + "</div></div><div class=box>All rights are with us, today and always.</div>"
                         + f"<div class=comments><p>{words(20)}</div>"))
        want[i] = "\n".join([title, *body])
    got = {r.page_id: r.text for r in X.extract_main_text(_pages(spark, rows)).collect()}
    assert got == want


def test_articles_next_to_everything_else(spark):
    source = """<!DOCTYPE html><html><head><title>no</title></head><body class="has-sidebar"><header><h1>Site</h1></header><nav>no</nav>
        <div class="cookie-notice">no</div><div class="sidebar-layout"><main><article class="post"><header><h1>Title</h1></header>
        <p>Text with <a href=x>a link</a>.</p><div class="advert">no</div><form>no</form><blockquote><p>Quote</blockquote>
        <footer>no</footer><section id="comments"><article>no</article></section></article></main><aside>no</aside></div>
        <div class="related-posts"><article>no</article></div><footer>no</footer>"""
    rows = [_row(1, "http://b.example/", source), _row(2, None, source), _row(1, "http://b.example/", source), _row(None, "no url", None),
            _row(3, "http://b.example/", ""), _row(4, "http://b.example/", "<nav>no</nav>"), _row(5, "http://c.example/", "plain words")]
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in X.extract_main_text(_pages(spark, rows)).collect()), key=str)
    text = "Title\nText with a link.\nQuote"
    want = [(1, "http://b.example/", text, len(text))] * 2 + [(2, None, text, len(text)), (3, "http://b.example/", "", 0), (4, "http://b.example/", "", 0),
            (5, "http://c.example/", "plain words", 11), (None, "no url", "", 0)]
    assert got == sorted(want, key=str)


def test_long_and_deep_pages(spark):
    deep = "<div>" * 5_000 + "deep" + "</div>" * 5_000
    rows = [_row(1, "http://d.example/", f"<article>{'<p>one para' * 20_000}</article>"), _row(2, "http://e.example/", deep)]
    got = {r.page_id: r.text for r in X.extract_main_text(_pages(spark, rows)).collect()}
    assert got == {1: "\n".join(["one para"] * 20_000), 2: "deep"}


def test_many_shapes_of_a_host_are_merged_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(X, "MERGED", 4)
    tags = ["h2", "ul", "table", "blockquote", "pre", "h3"]
    rows = [_row(i, "http://f.example/", "<article>" + "".join(f"<{t}>t{t}</{t}>" for k, t in enumerate(tags) if i >> k & 1) + f"<p>p{i}</article>") for i in range(64)]
    assert X.infer_wrappers(_pages(spark, rows).selectExpr("'f' AS host", "html")).count() == 1
    got = {r.page_id: r.text for r in X.extract_main_text(_pages(spark, rows)).collect()}
    assert got == {i: "\n".join([f"t{t}" for k, t in enumerate(tags) if i >> k & 1] + [f"p{i}"]) for i in range(64)}


def test_empty_table(spark):
    assert X.extract_main_text(_pages(spark, [])).collect() == []


def test_query_is_that_of_a_plain_reading(spark):
    """The provided pages are regular enough to be read with two patterns."""
    want = {}
    for page in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        inside = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", part)).split()) for part in re.split("</?(?:p|h1)>", inside)]
        want[page.page_id] = "\n".join(filter(None, blocks))
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op12_html_extraction"](spark, SF_DIR).collect()}
    assert got == {page_id: (text, len(text)) for page_id, text in want.items()} and len(got) > 200
