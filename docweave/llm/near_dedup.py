"""Near duplicates by an inverted join over the coordinates of MinHash signatures.

Documents with the same set of shingles become one class. A class is posted under the coordinate-value pairs of its
signature, rarest first: two signatures of K coordinates that agree in M of them share one of their first K - M + 1
postings. Lists are merged in two steps. First every class is compared with the first class of its lists; what is linked
then needs no more comparisons with each other and is skipped in the second step, where the classes of a list that are
still apart are compared block by block: agreeing coordinates are counted, and pairs with M or more are compared by
their sets, which only classes in such pairs bring along. All links are confirmed on the full sets of the texts.

With K = 32 and M = 14 a pair of similarity 0.8 fails the threshold about once in a million times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm import common
from docweave.llm.components import components
from docweave.llm.exact_dedup import located

COORDINATES, MATCHES = 32, 14
PREFIX = COORDINATES - MATCHES + 1
SIMILARITY = 80
#: Lists longer than this are hot. A class with a hot posting is posted under its first LOW coordinates instead of the
#: hot ones; a pair of similarity 0.8 agrees in one of them but for one case in ten million.
HOT, LOW = 512, 10
#: Rows of a list that meet in one block: classes that are apart, and all classes.
APART_BLOCK, ALL_BLOCK, BUNDLE_ROWS = 256, 512, 2_000
#: Hashes of words that a task keeps, at most.
KNOWN_WORDS = 100_000
#: Sets are compared by 32-bit hashes first; links within so many shingles of the limit are left to the full sets.
SLACK = 2

_U = np.uint64
_BITS = np.int64(1) << np.arange(COORDINATES)
_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(0, 2**63, COORDINATES, dtype=_U) * _U(2) + _U(1)
_SHIFTS = _RANDOM.integers(0, 2**63, COORDINATES, dtype=_U)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Hashed shingles of texts; hashes of words are kept in a bounded table."""

    def __init__(self, width: int):
        self.width, self.words = width, {}

    def hashes(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the word shingles; fewer words than the width are one shingle."""
        words = text.encode().lower().split()
        if not words:
            return np.zeros(0, _U)
        known = self.words
        if len(known) > KNOWN_WORDS:
            known.clear()
        out = []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh3_64_intdigest(word)
            out.append(value)
        h = np.array(out, _U)
        width = min(self.width, len(h))
        n = len(h) - width + 1
        mixed = _mixed(h[:n] + _U(width))
        for i in range(1, width):
            mixed = _mixed(mixed * _U(0x9E3779B97F4A7C15) + h[i : i + n])
        return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """For each coordinate the upper half of the least value of its hash function over the set."""
    least = np.full(COORDINATES, 2**64 - 1, _U)
    for start in range(0, len(shingles), 1024):
        least = np.minimum(least, (shingles[start : start + 1024, None] * _FACTORS + _SHIFTS).min(axis=0))
    return (least >> _U(32)).astype(np.uint32)


def shingle_set(text: str, width: int) -> set[tuple[bytes, ...]]:
    """The full set of shingles."""
    words = text.encode().lower().split()
    width = min(width, len(words)) or 1
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def _sketches(source: DataFrame, width: int) -> DataFrame:
    """row (a number of its own), doc_id, _file, _row, n, set_key, signature, brief.

    `brief` has the lower eight bits of each coordinate, four coordinates in a number. (A coordinate is a minimum: the
    upper bits of all large sets are zero.)
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, row = Shingler(width), TaskContext.get().partitionId() << 36
        for batch in common.blocks(batches):
            sets = [shingler.hashes(text) for text in batch.column("text").to_pylist()]
            signatures = [signature(s) for s in sets]
            columns = [
                pa.array(np.arange(row, row + len(sets))), *(batch.column(c) for c in ("doc_id", "_file", "_row")),
                pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets]),
                pa.array([own.view(np.int32) for own in signatures], pa.list_(pa.int32())),
                pa.array([own.astype(np.uint8).view("<i4") for own in signatures], pa.list_(pa.int32())),
            ]
            row += len(sets)
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "_file", "_row", "n", "set_key", "signature", "brief"])

    doc_id = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        sketch, f"row long, doc_id {doc_id}, _file string, _row long, n long, set_key binary, signature array<int>, brief array<int>"
    )


def _texts(nodes: DataFrame, reps: DataFrame, source: DataFrame) -> DataFrame:
    """node, text: the texts of some classes, read again from where they lie."""
    places = reps.join(common.small(nodes), "node").select("node", F.col("_file").alias("its_file"), F.col("_row").alias("its_row"))
    places = common.written(places, "places")
    here = (F.col("_file") == F.col("its_file")) & (F.col("_row") == F.col("its_row"))
    return common.written(source.join(common.small(places), here).select("node", "text"), "texts")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """node, short (32-bit hashes of the set of shingles)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in common.blocks(batches):
            hashes = [shingler.hashes(text) for text in batch.column("text").to_pylist()]
            shorts = [np.unique(h >> _U(32)).astype("<u4").tobytes() for h in hashes]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(shorts, pa.binary())], ["node", "short"])

    return common.written(texts.mapInArrow(sets, "node long, short binary"), "sets")


def _posts(classes: DataFrame) -> DataFrame:
    """token, head (least node of the token), node, posted: the postings that pairs above the threshold are sure to share.

    `posted` has a bit for each coordinate under which the node is posted.
    """
    tokens = classes.select("node", F.posexplode("signature")).select(
        "node", F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("col").cast("long").bitwiseAND(0xFFFFFFFF)).alias("token")
    )
    lists = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("z"), F.min("node").alias("head")).where("z > 1")
    lists = common.written(lists, "lists")
    by_node = tokens.join(lists, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("z", "token", "head"))).alias("shared"))
    # Postings that no other class has come first.
    room = F.greatest(F.lit(0), PREFIX - (COORDINATES - F.size("shared")))
    prefix = by_node.select("node", "shared", F.slice("shared", 1, room).alias("prefix"))
    hot = F.exists("prefix", lambda t: t["z"] > HOT)
    cool = F.filter("prefix", lambda t: t["z"] <= HOT)
    low = F.filter("shared", lambda t: t["token"] < (LOW << 32))
    chosen = prefix.select("node", F.when(hot, F.array_union(cool, low)).otherwise(cool).alias("chosen"))
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(t["token"], 32).cast("int"))
    posted = F.aggregate("chosen", F.lit(0).cast("long"), lambda bits, t: bits.bitwiseOR(bit(t)))
    return chosen.select("node", posted.alias("posted"), F.explode("chosen").alias("t")).select("t.token", "t.head", "node", "posted")


def _same_bytes(a: Column, b: Column) -> Column:
    """How many of the four bytes of two numbers are equal."""
    differ = a.bitwiseXOR(b).cast("long").bitwiseAND(0xFFFFFFFF)
    # The upper bit of each byte that is not zero.
    marks = (differ.bitwiseAND(0x7F7F7F7F) + 0x7F7F7F7F).bitwiseOR(differ).bitwiseAND(0x80808080)
    return 4 - F.bit_count(marks)


def _similar(a: np.ndarray, b: np.ndarray, slack: int) -> bool:
    """Whether sorted sets of 32-bit hashes are similar enough, `slack` shingles short or over allowed for."""
    both = np.concatenate([a, b])
    both.sort()
    common_ = int((both[1:] == both[:-1]).sum())
    return 100 * (common_ + slack) >= SIMILARITY * (len(a) + len(b) - common_ - slack)


def _nodes(pairs: DataFrame) -> DataFrame:
    """The nodes of pairs."""
    return common.written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")


def _first_links(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b with both sets) that are similar by their short sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.blocks(batches):
            sets = zip(batch.column("short_a").to_pylist(), batch.column("short_b").to_pylist())
            near = pa.array([_similar(np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4"), SLACK) for a, b in sets], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    return pairs.select("a", "b", "short_a", "short_b").mapInArrow(compare, "a long, b long")


class _Block:
    """Rows of one list: classes that are apart (`left`), all classes of a block (`right`), and which of them may be near."""

    def __init__(self, rows: pa.Table):
        column = lambda name: rows.column(name).to_numpy()
        self.node, self.n, self.component = column("node"), column("n"), column("component")
        self.posted, self.bit = column("posted"), 1 << (rows.column("token")[0].as_py() >> 32)
        self.brief = rows.column("brief").combine_chunks().flatten().to_numpy().astype("<i4").view(np.uint8).reshape(-1, COORDINATES)
        # Coordinates under which a row is posted; zero elsewhere.
        self.values = np.zeros((rows.num_rows, COORDINATES), np.int32)
        self.values[(self.posted[:, None] & _BITS) != 0] = rows.column("values").combine_chunks().flatten().to_numpy()
        self.left = np.flatnonzero(column("own_a") == column("a_block"))
        self.right = np.flatnonzero(column("own_b") == column("b_block"))

    def near(self, i: int) -> np.ndarray:
        """Rows of `right` of other components, of a fitting size, that agree with row i in MATCHES brief coordinates.

        A pair that meets in several lists counts in that of the first coordinate under which both are posted.
        """
        n, right = self.n, self.right
        fits = (100 * np.minimum(n[right], n[i]) >= SIMILARITY * np.maximum(n[right], n[i])) & (self.component[right] != self.component[i])
        fitting = right[fits]
        fitting = fitting[(self.brief[fitting] == self.brief[i]).sum(axis=1) >= MATCHES]
        shared = ((self.values[fitting] == self.values[i]) @ _BITS) & self.posted[fitting] & self.posted[i]
        return fitting[shared & -shared == self.bit]


def _lists(block: pa.Table) -> Iterator[pa.Table]:
    """The lists of a block: several short ones, or a part of a long one."""
    block = block.sort_by("token")
    token = block.column("token").to_numpy()
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    for start, end in zip(starts, np.append(starts[1:], len(token))):
        yield block.slice(start, end - start)


_BLOCK = ("bundle", "token", "posted", "a_block", "b_block", "node", "component", "own_a", "own_b")
_BLOCK_FIELDS = ", ".join(f"{name} long" for name in _BLOCK)
_SIGNED = "n long, brief array<int>, values array<int>"


def _possible_rows(block: pa.Table) -> pa.Table:
    """Rows that agree with another one in enough coordinates to be near it."""
    kept = []
    for rows in _lists(block):
        own, possible = _Block(rows), np.zeros(rows.num_rows, bool)
        for i in own.left.tolist():
            near = own.near(i)
            if len(near):
                possible[i], possible[near] = True, True
        kept.append(rows.filter(pa.array(possible)).select([*_BLOCK, "n", "brief", "values"]))
    return pa.concat_tables(kept)


def _block_links(block: pa.Table) -> pa.Table:
    """Links between classes of different components that meet in a block.

    What a sure link joins is skipped from then on; links near the limit join nothing, so that no other link is lost.
    """
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    for rows in _lists(block):
        own = _Block(rows)
        shorts = [np.frombuffer(s, "<u4") for s in rows.column("short").to_pylist()]
        for i in own.left.tolist():
            for j in own.near(i).tolist():
                a, b = root(int(own.component[i])), root(int(own.component[j]))
                if a != b and _similar(shorts[i], shorts[j], SLACK):
                    out.append((int(own.node[i]), int(own.node[j])))
                    if _similar(shorts[i], shorts[j], -SLACK):
                        parent[a] = b
    return pa.table({"a": pa.array([o[0] for o in out], pa.int64()), "b": pa.array([o[1] for o in out], pa.int64())})


def _blocks(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of lists with classes of several components, dealt to the blocks in which they meet.

    Short lists share a bundle of about BUNDLE_ROWS rows; a long list is cut into blocks, so that no task gets all of it.
    """
    placed = posts.join(labels, "node", "left").select("token", "node", "posted", F.coalesce("component", "node").alias("component"))
    placed = common.written(placed, "placed")
    firsts = placed.groupBy("token").agg(F.min(F.struct("node", "component")).alias("first"), F.count(F.lit(1)).alias("z"), F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = firsts.where("z > 1 AND low < high").select("token", F.col("first.component").alias("main"), "z")
    rows = placed.join(mixed, "token")
    apart = F.col("component") != F.col("main")
    counts = rows.groupBy("token").agg(F.count_if(apart).alias("n_apart"), F.first("main").alias("main"), F.first("z").alias("z"))
    counts = common.written(
        counts.select("token", "main", F.ceil(F.col("n_apart") / APART_BLOCK).alias("a_blocks"), F.ceil(F.col("z") / ALL_BLOCK).alias("b_blocks")), "mixed"
    )
    part = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks))
    rows = placed.join(counts, "token").select(
        "token", "node", "posted", "component", "a_blocks", "b_blocks", F.when(apart, part("a_blocks")).otherwise(F.lit(-1)).alias("own_a"), part("b_blocks").alias("own_b")
    )
    as_b = F.transform(F.sequence(F.lit(0), F.col("a_blocks") - 1), lambda a: F.struct(a.alias("a_block"), F.col("own_b").alias("b_block")))
    as_a = F.when(F.col("own_a") >= 0, F.transform(F.sequence(F.lit(0), F.col("b_blocks") - 1), lambda b: F.struct(F.col("own_a").alias("a_block"), b.alias("b_block"))))
    dealt = rows.select("token", "node", "posted", "component", "a_blocks", "b_blocks", "own_a", "own_b", F.explode(F.array_union(as_b, F.coalesce(as_a, F.array().cast(rows.select(as_b).schema[0].dataType)))).alias("k"))
    whole = (F.col("a_blocks") == 1) & (F.col("b_blocks") == 1)
    bundles = max(1, placed.count() // BUNDLE_ROWS)
    bundle = F.when(whole, F.pmod(F.xxhash64("token"), F.lit(bundles))).otherwise(-F.abs(F.xxhash64("token", "k.a_block", "k.b_block")))
    return dealt.select(bundle.alias("bundle"), "token", "posted", "k.*", "node", "component", "own_a", "own_b")


def _confirmed(links: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Links whose full sets are similar enough."""
    texts = texts.join(common.small(_nodes(links)), "node")
    pairs = links.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.blocks(batches):
            near = []
            for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                a, b = shingle_set(a, width), shingle_set(b, width)
                both = len(a & b)
                near.append(100 * both >= SIMILARITY * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a long, b long")


def near_dedup(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept, stays, _file, _row.

    Documents are linked when the shingles they share are 80 in 100 of all they have. component_id is the least id that
    can be reached by links; `kept` says that it is the row's own. `stays` holds for exactly one row of a group: of rows
    with the same id the one that lies first. Null and empty texts have no shingles, are linked with nothing and stay.
    Null ids come last: a group of null ids has a null component_id and `kept` is true for all of it.
    """
    common.ship_package(docs.sparkSession)
    with common.temporary_tables(docs.sparkSession):
        return _linked(docs, width, id_col, text_col)


def _linked(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    source = located(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), "_file", "_row")
    sketches = common.written(_sketches(source, width), "sketches")
    # What the result is read from, without the signatures.
    places = common.written(sketches.select("row", "doc_id", "_file", "_row", "n", "set_key"), "rows", keep=True)
    by_id = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "_file", "_row", "row")
    keys = sketches.where("n > 0").groupBy("set_key").agg(F.min(by_id).alias("rep"))
    keys = common.written(keys.select("set_key", F.col("rep.row").alias("node"), "rep"), "classes", keep=True)
    reps = keys.select("node", "rep._file", "rep._row")
    classes = sketches.select(F.col("row").alias("node"), "n", "signature", "brief").join(common.small(keys.select("node")), "node")
    posts = common.written(_posts(classes.select("node", "signature")), "posts")

    firsts = posts.where("head < node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    # Coordinates are compared by eight bits: no pair that agrees is missed, and the sets decide anyway.
    short_of = lambda side: classes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("brief").alias(f"s_{side}"))
    matches = F.aggregate(F.zip_with("s_a", "s_b", _same_bytes), F.lit(0), lambda total, same: total + same)
    fits = 100 * F.least("n_a", "n_b") >= SIMILARITY * F.greatest("n_a", "n_b")
    checked = firsts.join(short_of("a"), "a").join(short_of("b"), "b").where(fits).where(matches >= MATCHES).select("a", "b")
    checked = common.written(checked, "pairs")
    # Sets and texts are long: only those of classes in such pairs are made, and they go once the links are known.
    with common.temporary_tables(docs.sparkSession):
        texts = _texts(_nodes(checked), reps, source)
        sets = _sets(texts, width)
        set_of = lambda side: sets.select(F.col("node").alias(side), F.col("short").alias(f"short_{side}"))
        links = common.written(_first_links(checked.join(set_of("a"), "a").join(set_of("b"), "b")), "first-links")
        sure = common.written(_confirmed(links, texts, width), "sure-links", outer=True)
    labels = common.written(components(sure), "labels")

    blocks = _blocks(posts, labels)
    # Of a signature, a list needs the coordinates under which a class is posted in full, the others in brief.
    posted = lambda _, at: F.call_function("shiftright", "posted", at).bitwiseAND(1) == 1
    of_node = classes.select("node", "n", "brief", "signature")
    signed = blocks.join(of_node, "node").select(*blocks.columns, "n", "brief", F.filter("signature", posted).alias("values"))
    possible = common.written(signed.groupBy("bundle").applyInArrow(_possible_rows, f"{_BLOCK_FIELDS}, {_SIGNED}"), "possible")
    with common.temporary_tables(docs.sparkSession):
        # Only rows that may be near another one bring their sets along.
        texts = _texts(common.written(possible.select("node").distinct(), "nodes"), reps, source)
        more = possible.join(_sets(texts, width), "node").groupBy("bundle").applyInArrow(_block_links, "a long, b long")
        more = more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        sure_more = common.written(_confirmed(common.written(more, "block-links"), texts, width), "sure-links", outer=True)
    labels = common.written(components(sure.unionByName(sure_more)), "labels", keep=True)

    named = keys.join(labels, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"), "rep")
    groups = named.groupBy("component").agg(F.min("rep").alias("first"))
    of_key = named.select("set_key", "component").join(groups, "component").select("set_key", "first")
    rows = places.join(of_key, "set_key", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        ((F.col("n") == 0) | (F.col("row") == F.col("first.row"))).alias("stays"), "_file", "_row",
    )


def drop_near_copies(docs: DataFrame, width: int = 5) -> DataFrame:
    """The rows of `docs` that stay, with their columns."""
    source = located(docs)
    gone = near_dedup(source, width).where(~F.col("stays")).select(F.col("_file").alias("_gone_file"), F.col("_row").alias("_gone_row"))
    same = (F.col("_file") == F.col("_gone_file")) & (F.col("_row") == F.col("_gone_row"))
    return source.join(common.small(common.written(gone, "gone")), same, "left_anti").select(*docs.columns)
