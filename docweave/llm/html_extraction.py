"""Main text of web pages by wrappers: one union-free regular expression for the pages of each host.

1. Each page is folded into an expression: its stream of block tokens, repetitions as items that repeat, texts as slots.
   Spark keeps the distinct expressions of each host.
2. Expressions of a host are aligned one after the other. A mismatch is first resolved as one more round of a repeated
   item or group, else what only one side has becomes optional. Hosts with many expressions are merged in rounds over
   parts of bounded size, so no task holds all of a host.
3. What a slot is follows from the elements above it: part of an article, set apart (menus, adverts, ...), or open. Open
   slots are judged by all pages of the host: a text that most pages share belongs to the template, and so do slots that
   are mostly links; the region that holds most of the rest is the main text.
4. Each page is placed in its host's wrapper and returns the blocks of its slots.

Pages meet their wrapper by a broadcast of the wrappers if these were measured small, else by a join on the host that
adaptive execution splits; html is never grouped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache, reduce

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm import common, html_parts as H

#: Expressions that are merged in one task, about.
MERGED = 256
#: A text is part of the template if so many pages have the slot, and this share of them has the same text in it.
PAGES, SHARED = 4, 0.5
#: Share of the open text that the main region holds at least; share of linked characters from which a slot is a menu.
REGION, LINKED = 0.75, 0.5
ARTICLE, MAIN, REST, OPEN, APART = 3, 2, 1, -1, 0

# Elements, roles and words in classes or ids that tell what a part of a page is for.
_APART_TAGS = frozenset("nav aside footer form menu dialog search fieldset".split())
_APART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_APART_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social pagination pager toolbar copyright masthead "
    "topbar".split()
)
# Parts that may hold articles of their own: answers of readers, and other pages.
_OTHERS_WORDS = frozenset("comment comments commentlist reply replies respond disqus related recommended recommendations teaser".split())
_NEGATED = frozenset("no has with without".split())
_MAIN_WORDS = frozenset("article post entry story".split())


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; '' without one. Pages without a host share a wrapper."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _named(names: list[str], wanted: frozenset[str]) -> bool:
    """Whether a class or id has one of the words, other than after a word like 'no'."""
    listed = (H.words_of(name) for name in names)
    return any(word in wanted and not (i and words[i - 1] in _NEGATED) for words in listed for i, word in enumerate(words))


@lru_cache(maxsize=4096)
def _kind(label: str) -> tuple[int, bool]:
    """ARTICLE, MAIN, APART or OPEN; and whether that holds whatever is inside."""
    tag = label.split(".", 1)[0].split("@", 1)[0]
    classes, *roles = label[len(tag) :].split("@")
    names = classes.split(".")
    if "hidden" in roles or _named(names, _OTHERS_WORDS):
        return APART, True
    if tag in _APART_TAGS or not _APART_ROLES.isdisjoint(roles) or _named(names, _APART_WORDS):
        return APART, False
    if tag == "article" or "article" in roles:
        return ARTICLE, True
    if tag == "main" or "main" in roles:
        return MAIN, True
    if _named(names, _MAIN_WORDS):
        return MAIN, False
    return (APART, False) if tag == "header" else (OPEN, False)


def levels(items: list) -> list[int]:
    """What each text slot of an expression is, from the elements above it.

    Outside articles, an element that holds an article or main element is not set apart, unless it is a part with
    articles of others. A header inside an article belongs to it.
    """
    slots = [above for above, _ in H.leaves(items)]
    holds = {number for above in slots for i, (_, label) in enumerate(above) if _kind(label) in ((ARTICLE, True), (MAIN, True)) for number, _ in above[:i]}
    out = []
    for above in slots:
        level = OPEN
        for number, label in above:
            kind, always = _kind(label)
            if kind == APART and (always or (number not in holds if level <= 0 else not label.startswith("header"))):
                level = APART
                break
            level = max(level, kind) if kind > 0 else level
        out.append(level)
    return out


def _region(items: list, marks: list[int], stats: dict[int, dict]) -> list[int]:
    """`marks` with every open slot decided by what the host's pages have in it."""
    slots = [above for above, _ in H.leaves(items)]
    weight, shared = {}, set()
    for slot, stat in stats.items():
        if stat["pages"] >= PAGES and stat["most"] >= SHARED * stat["pages"]:
            shared.add(slot)
        elif stat["linked"] < LINKED * stat["chars"]:
            weight[slot] = stat["chars"]
    total, chosen, longest = sum(weight.values()), 0, 0
    inside: dict[int, int] = {}
    for slot, chars in weight.items():
        for depth, (number, _) in enumerate(slots[slot], 1):
            inside[number] = inside.get(number, 0) + chars
    for slot in weight:  # the deepest element that holds most of it
        for depth, (number, _) in enumerate(slots[slot], 1):
            if depth > longest and inside[number] >= REGION * total:
                chosen, longest = number, depth
    out = []
    for slot, (above, mark) in enumerate(zip(slots, marks)):
        if mark == OPEN:
            heading = above and above[-1][1][:2] in ("h1", "h2") and slot in weight
            within = slot in weight and (not chosen or any(number == chosen for number, _ in above))
            mark = REST if heading or within else APART
        out.append(mark)
    return out


@lru_cache(maxsize=512)
def _wrapper(text: str) -> tuple[list, dict[int, int]]:
    items = H.filled(json.loads(text))
    return items, {id(item): slot for slot, (_, item) in enumerate(H.leaves(items))}


def _shape(items: list) -> str:
    return json.dumps(H.bare(items), separators=(",", ":"), ensure_ascii=False)


class _Placed:
    """Slots of the blocks of a page; for pages of the same shape they are looked up."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, str], list[int | None]] = {}

    def slots(self, page: H.Page, wrapper: str) -> list[int | None]:
        leaves = H.leaves(page.items)
        members = [list(item[4]) for _, item in leaves]
        name = (_shape(page.items), wrapper)
        found = self.known.get(name)
        if found is None:
            first = [own[0] for own in members]
            placed: dict[int, int] = {}
            items, slots = _wrapper(wrapper)
            H.place(items, page.items, slots, placed)
            found = [placed.get(block) for block in first]
            if len(self.known) >= 2_000:
                self.known.clear()
            self.known[name] = found
        out: list[int | None] = [None] * len(page.texts)
        for own, slot in zip(members, found):
            for block in own:
                out[block] = slot
        return out


def shapes(pages: DataFrame) -> DataFrame:
    """Distinct (host, shape) of pages (host, html)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {(host, _shape(H.read_page(text.as_py()).items)) for host, text in zip(batch.column("host").to_pylist(), batch.column("html"))}
            hosts, found = zip(*seen) if seen else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(found, pa.string())], ["host", "shape"])

    return pages.mapInArrow(read, "host string, shape string").distinct()


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    ordered = (H.filled(json.loads(shape)) for shape in sorted(rows["shape"]))
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "shape": [_shape(reduce(H.merge, ordered))]})


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, shape): one expression per host that covers the shapes of all its pages.

    The rounds depend on the shapes alone, not on how pages are spread over files.
    """
    found = common.written(shapes(pages), "shapes")
    largest = found.groupBy("host").count().agg(F.max("count")).first()[0] or 1
    parts = 1
    while largest > MERGED * parts:
        parts *= 2
    while True:
        part = F.pmod(F.xxhash64("shape"), F.lit(parts))
        grouped = found.withColumn("part", part).groupBy("host", "part")
        found = grouped.applyInPandas(lambda rows: _merged(rows), "host string, shape string")
        if parts == 1:
            return found
        found = common.written(found.distinct(), "shapes")
        parts = max(1, parts // MERGED)


def _text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _slot_statistics(pages: DataFrame) -> DataFrame:
    """(host, stats): of each open slot the pages that have it, the most pages with one text in it, its characters."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placed = _Placed()
        for batch in batches:
            out = []
            for host, wrapper, text in zip(*(batch.column(name).to_pylist() for name in ("host", "shape", "html"))):
                page, marks = H.read_page(text), levels(_wrapper(wrapper)[0])
                found: dict[int, list] = {}
                for block, slot in enumerate(placed.slots(page, wrapper)):
                    if slot is not None and marks[slot] == OPEN:
                        found.setdefault(slot, []).append(block)
                for slot, own in found.items():
                    value = _text_hash("\n".join(page.texts[block] for block in own))
                    out.append((host, slot, value, sum(len(page.texts[block]) for block in own), sum(page.linked[block] for block in own)))
            columns = list(zip(*out)) or [()] * 5
            types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, types)], ["host", "slot", "value", "chars", "linked"])

    texts = pages.mapInArrow(read, "host string, slot int, value long, chars long, linked long")
    by_text = texts.groupBy("host", "slot", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    by_slot = by_text.groupBy("host", "slot").agg(
        F.sum("n").alias("pages"), F.max("n").alias("most"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked")
    )
    # One entry per slot of the wrapper.
    return by_slot.groupBy("host").agg(F.to_json(F.collect_list(F.struct("slot", "pages", "most", "chars", "linked"))).alias("stats"))


def learn_wrappers(pages: DataFrame) -> DataFrame:
    """(host, shape, marks): the wrapper of each host and what each of its text slots is, from pages (host, html)."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for shape, stats in zip(batch.column("shape").to_pylist(), batch.column("stats").to_pylist()):
                items = _wrapper(shape)[0]
                known = {int(stat["slot"]): stat for stat in json.loads(stats or "[]")}
                out.append(_region(items, levels(items), known))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("shape"), pa.array(out, pa.list_(pa.int32()))], ["host", "shape", "marks"]
            )

    def open_only(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield batch.filter(pa.array([OPEN in levels(_wrapper(shape)[0]) for shape in batch.column("shape").to_pylist()], pa.bool_()))

    wrappers = common.written(infer_wrappers(pages), "wrappers")
    undecided = common.written(wrappers.mapInArrow(open_only, wrappers.schema), "undecided")
    if undecided.isEmpty():
        judged = wrappers.withColumn("stats", F.lit(None).cast("string"))
    else:
        stats = _slot_statistics(pages.join(common.small(undecided), "host"))
        judged = wrappers.join(stats, "host", "left")
    return judged.mapInArrow(marked, "host string, shape string, marks array<int>")


def main_text(page: H.Page, slots: list[int | None], marks: list[int]) -> str:
    """The blocks of the best kind that the page has: of its articles, else of its main element, else of the main region."""
    own: list[int] | None = None
    kinds = []
    for block, slot in enumerate(slots):
        if slot is None:  # a shape that the wrapper was not made from
            if own is None:
                own = [0] * len(page.texts)
                for level, (_, item) in zip(levels(page.items), H.leaves(page.items)):
                    for member in item[4]:
                        own[member] = REST if level == OPEN else level
            kinds.append(own[block])
        else:
            kinds.append(marks[slot])
    best = max(kinds, default=APART)
    return "\n".join(text for text, kind in zip(page.texts, kinds) if kind == best) if best > APART else ""


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text (blocks joined by line breaks) and n_chars of every page; '' and 0 where there is no main text.

    Null html counts as empty, a null url as one without host. Ids may be null or repeated: rows are judged one by one,
    repeated pages count in the statistics of their host like others. Whole pages are read, however long.
    """
    common.ship_package(pages.sparkSession)
    source = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    wrappers = common.written(learn_wrappers(source.select("host", "html")), "marked-wrappers")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placed = _Placed()
        for batch in batches:
            texts = []
            for source, wrapper, marks in zip(batch.column("html"), batch.column("shape").to_pylist(), batch.column("marks").to_pylist()):
                page = H.read_page(source.as_py())
                texts.append(main_text(page, placed.slots(page, wrapper), marks))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    id_type = source.schema["page_id"].dataType.simpleString()
    joined = source.join(common.small(wrappers), "host").select("page_id", "url", "html", "shape", "marks")
    return joined.mapInArrow(read, f"page_id {id_type}, url string, text string, n_chars long")
