"""Phrase collocations from a weighted de Bruijn graph of words, per language.

Texts are lower-cased (A to Z), split at ``[.,;:!?`` and line breaks``]`` into
pieces and at spaces and tabs into words. The graph's nodes are three words, its
edges four words, weighted by their number of places.

1. *Cut.* Hashed counters of words, of neighbouring pairs and of triples, summed
   over all tasks, tell which of them can reach ``min_count``. Where one cannot, the
   text is cut: no phrase with ``min_count`` places is touched, since each of its
   parts has as many. Equal hashes let more through; they never lose or change a
   count. The counters grow with the rows up to ``MOST_COUNTERS``, which bounds the
   broadcast bitmap (one bit each); fuller counters cut less.
2. *Edges.* Each place gives one row: the edge that begins there, or, where a piece
   or a cut ends it earlier, the one to three words up to there. Only these are
   shuffled, summed on the map side first.
3. *Flow.* A node's count is its outgoing flow plus the ends of three words. Two
   words have the sum of the nodes that begin with them plus the ends of two words,
   and one word likewise. So each shorter count comes from the next longer one and
   its end correction.
4. *Compaction.* A node is unary when one edge enters it, one leaves it, and
   nothing begins or ends there. Chains of unary nodes become one path of any length
   with one count (``paths``), by pointer doubling over the frequent nodes.
   Phrases of four words are read off the paths. A ring of unary nodes has no
   first node; its edges stay paths of their own.
5. *Scores.* ``collocations`` says how.

Null texts are empty, a null language is ``und``. Repeated rows count each. Empty
tables give empty results. Ids are not read. A long text is worked on in parts,
cut at the ends of pieces. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wattspan.functions.columns import qcol, require
from wattspan.llm.batches import SLICE_BYTES, Prefix, lowered, mix, ragged, runs, slices, table_of
from wattspan.llm.frames import scratch

MIN_COUNT = 30
INSIDE_PERCENT = 80
FIRST = 2000
WORDS = 4
LEAST_COUNTERS = 1 << 20
MOST_COUNTERS = 1 << 25
COUNTERS_PER_ROW = 64
SEGMENT = 1 << 16
PART_BYTES = SLICE_BYTES // 4

# The ends of pieces, and what parts words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_GAPS = b"\x20\x09"

_IS_END = table_of(PIECE_ENDS)
_IS_GAP = table_of(WORD_GAPS)
_U = np.uint64


def _parts(column: pa.Array, size: int = PART_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of slices; a text over the size comes in parts that end where a piece does."""
    for lo, hi, data, off in slices(column, size):
        if hi - lo > 1 or len(data) <= 2 * size:
            yield lo, data, off
            continue
        ends = np.flatnonzero(_IS_END[data]) + 1
        at = 0
        while at < len(data):
            cut = ends[max(np.searchsorted(ends, at + size, side="right") - 1, 0)] if len(ends) else len(data)
            if cut <= at:
                # A piece over the size stays whole.
                later = np.searchsorted(ends, at, side="right")
                cut = ends[later] if later < len(ends) else len(data)
            yield lo, data[at:cut], np.array([0, cut - at])
            at = int(cut)


def _words(data: np.ndarray, off: np.ndarray, salt: np.ndarray):
    """Bounds and text of the words, and hashes of words, pairs and triples with whether a pair or triple stands in one piece."""
    ends_at = _IS_END[data]
    starts, ends = runs(~(ends_at | _IS_GAP[data]), off)
    text = np.searchsorted(off, starts, side="right") - 1
    stops = np.zeros(len(data) + 1, np.int64)
    np.cumsum(ends_at, out=stops[1:])
    h = mix(Prefix(data).of(starts, ends) + salt[text])
    near = (text[1:] == text[:-1]) & (stops[starts[1:]] == stops[ends[:-1]])
    pairs = mix(h[:-1] * _U(0xD6E8FEB86659FD93) + h[1:])
    triples = mix(pairs[:-1] * _U(0xCA5A826395121157) + h[2:])
    return starts, ends, text, h, pairs, near, triples, near[:-1] & near[1:]


def _languages(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The batch's languages and a number to mix into the hashes of each row."""
    names = batch.column("_lang")
    coded = names.dictionary_encode()
    salts = np.array([int.from_bytes(x.as_py().encode()[:7], "little") for x in coded.dictionary], _U)
    return names, mix(mix(salts)[coded.indices.to_numpy()]) if len(names) else np.zeros(0, _U)


def _may_reach(docs: DataFrame, counters: int, min_count: int) -> np.ndarray:
    """One bit per counter: whether it reached ``min_count``."""
    kind = np.uint8 if min_count < 256 else np.uint32
    step = min(SEGMENT, counters)

    def fill(batches):
        counts = np.zeros(counters, np.uint32)
        for batch in batches:
            _, salt = _languages(batch)
            for lo, data, off in _parts(batch.column("_text")):
                _, _, _, h, pairs, near, triples, all_ = _words(lowered(data), off, salt[lo:lo + len(off) - 1])
                for keys in (h, pairs[near], triples[all_]):
                    np.add.at(counts, (keys & _U(counters - 1)).astype(np.int64), 1)
            # Sums that reached the limit need no more.
            np.minimum(counts, 1 << 30, out=counts)
        low = np.minimum(counts, min_count).astype(kind)
        at = [i for i in range(0, counters, step) if low[i:i + step].any()]
        for k in range(0, len(at), 64):
            part = at[k:k + 64]
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array(part, pa.int64()),
                "counts": [pa.compress(low[i:i + step].tobytes(), codec="zstd", asbytes=True) for i in part]})

    def merge(batches):
        at, total = None, None
        out = lambda: pa.RecordBatch.from_pydict({
            "segment": pa.array([at], pa.int64()), "bits": [np.packbits(total >= min_count, bitorder="little").tobytes()]})
        for batch in batches:
            for segment, packed in zip(batch.column("segment").to_pylist(), batch.column("counts")):
                own = np.frombuffer(pa.decompress(packed.as_py(), step * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)
                if segment != at:
                    if at is not None:
                        yield out()
                    at, total = segment, own.astype(np.int64)
                else:
                    total += own
        if at is not None:
            yield out()

    filled = docs.mapInArrow(fill, "segment bigint, counts binary")
    merged = filled.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment bigint, bits binary")
    bits = np.zeros(max(counters // 8, 1), np.uint8)
    for row in merged.toLocalIterator():
        bits[row.segment // 8:(row.segment + step) // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def _grams(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """``lang``, ``k``, ``g``, ``c``: edges (k = 4), ends (k = 1 to 3), and numbers of words (k = 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        seen, mask = shared.value, _U(len(shared.value) * 8 - 1)
        bit = lambda keys: (seen[(k := (keys & mask).astype(np.int64)) >> 3] >> (k & 7).astype(np.uint8) & 1).astype(bool)
        for batch in batches:
            names, salt = _languages(batch)
            for lo, data, off in _parts(batch.column("_text")):
                data = lowered(data)
                starts, ends, text, h, pairs, near, triples, all_ = _words(data, off, salt[lo:lo + len(off) - 1])
                n = len(starts)
                if not n:
                    continue
                often = bit(h)
                two, three = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
                two[:n - 1] = near & often[:-1] & often[1:] & bit(pairs)
                three[:max(n - 2, 0)] = all_ & two[:n - 2] & two[1:n - 1] & bit(triples) if n > 2 else False
                first = np.flatnonzero(often)
                final = first + two[first] + three[first] + (three[first] & three[first + 1])
                size = ends - starts
                at = np.cumsum(size + 1) - size - 1
                spaced = data[np.minimum(ragged(starts, size + 1), len(data) - 1)]
                spaced[at + size] = 32
                length = at[final] + size[final] - at[first]
                edges = np.zeros(len(first) + 1, np.int32)
                np.cumsum(length, out=edges[1:])
                grams = pa.StringArray.from_buffers(len(first), pa.py_buffer(edges), pa.py_buffer(spaced[ragged(at[first], length)]))
                yield pa.RecordBatch.from_pydict({
                    "lang": names.take(pa.array(lo + text[first])), "k": pa.array((final - first + 1).astype(np.int32)),
                    "g": grams, "c": pa.array(np.ones(len(first), np.int64))})
                rows, words = np.unique(text, return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": names.take(pa.array(lo + rows)), "k": pa.array(np.zeros(len(rows), np.int32)),
                    "g": pa.array([""] * len(rows)), "c": pa.array(words.astype(np.int64))})

    return docs.mapInArrow(run, "lang string, k int, g string, c bigint")


def _first(g: Column | str, k: int) -> Column:
    return F.substring_index(g, " ", k)


def _last(g: Column | str, k: int) -> Column:
    return F.substring_index(g, " ", -k)


class Graph:
    """Counts of one corpus; every frame has ``lang``.

    ``words``: ``n``, all words. ``edges``: ``g``, ``c``. ``nodes``: ``g``, ``f``, and whether it is ``unary``.
    ``pairs`` and ``singles``: ``g``, ``f``. Only what has ``min_count`` places is kept, with whole counts.
    """

    def __init__(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 most_counters: int = MOST_COUNTERS):
        require(docs, [text_col, lang_col])
        self.min_count = min_count
        slim = docs.select(qcol(text_col).cast("string").alias("_text"),
                           F.coalesce(qcol(lang_col).cast("string"), F.lit("und")).alias("_lang"))
        wanted = 1 << (docs.count() * COUNTERS_PER_ROW).bit_length()
        bits = _may_reach(slim, max(min(LEAST_COUNTERS, most_counters), min(most_counters, wanted)), min_count)
        counts = scratch(_grams(slim, bits).groupBy("lang", "k", "g").agg(F.sum("c").alias("c")), "grams")
        often = F.col("f") >= min_count
        self.words = counts.filter("k = 0").select("lang", F.col("c").alias("n"))
        edges, ends = counts.filter("k = 4").select("lang", "g", "c"), counts.filter("k BETWEEN 1 AND 3")
        # Outgoing flow, and what ends here.
        nodes = scratch(
            edges.select("lang", _first("g", 3).alias("g"), "c", F.lit(1).alias("out"), F.lit(0).alias("ends"))
            .unionAll(ends.filter("k = 3").select("lang", "g", "c", F.lit(0), F.lit(1)))
            .groupBy("lang", "g").agg(F.sum("c").alias("f"), F.sum("out").alias("out"), F.sum("ends").alias("ends")), "nodes")
        shorter = lambda longer, k: (
            longer.select("lang", _first("g", k).alias("g"), "f")
            .unionAll(ends.filter(F.col("k") == k).select("lang", "g", "c"))
            .groupBy("lang", "g").agg(F.sum("f").alias("f")))
        pairs = scratch(shorter(nodes, 2), "pairs")
        self.pairs, self.singles = pairs.filter(often), shorter(pairs, 1).filter(often)
        self.edges = edges.filter(F.col("c") >= min_count)
        entering = edges.groupBy("lang", _last("g", 3).alias("g")).agg(
            F.sum("c").alias("inflow"), F.count(F.lit(1)).alias("into")).filter(F.col("inflow") >= min_count)
        unary = F.coalesce(F.expr("out = 1 AND ends = 0 AND into = 1 AND inflow = f"), F.lit(False))
        self.nodes = scratch(
            nodes.filter(often).join(entering, ["lang", "g"], "left").select("lang", "g", "f", unary.alias("unary")), "frequent")

    def paths(self) -> DataFrame:
        """``lang``, ``path``, ``n_words`` (4 or more), ``c``: every frequent edge lies on exactly one path."""
        inner = self.nodes.filter("unary").select("lang", F.col("g").alias("u"))
        from_, to = _first("g", 3), _last("g", 3)
        edges = scratch(
            self.edges.select("lang", "g", "c", from_.alias("p"), to.alias("s"))
            .join(inner.select("lang", F.col("u").alias("p"), F.lit(True).alias("_pu")), ["lang", "p"], "left")
            .join(inner.select("lang", F.col("u").alias("s"), F.lit(True).alias("_su")), ["lang", "s"], "left")
            .select("lang", "g", "c", "p", "s", F.col("_pu").isNotNull().alias("pu"), F.col("_su").isNotNull().alias("su")),
            "path-edges")
        # A unary node's one entering edge tells the node before it.
        step = edges.filter("su").select("lang", F.col("s").alias("u"), F.when(F.col("pu"), F.col("p")).alias("before"))
        at = scratch(step.select("lang", "u", F.coalesce("before", "u").alias("head"),
                                 F.when(F.col("before").isNull(), 0).otherwise(1).cast("bigint").alias("d"),
                                 F.col("before").isNull().alias("done")), "chains")
        for _ in range(at.count().bit_length() + 1):
            if at.filter("NOT done").isEmpty():
                break
            ahead = at.select("lang", F.col("u").alias("head"), F.col("head").alias("_h"), F.col("d").alias("_d"),
                              F.col("done").alias("_done"))
            at = scratch(
                at.filter("done").unionAll(at.filter("NOT done").join(ahead, ["lang", "head"]).select(
                    "lang", "u", F.col("_h").alias("head"), (F.col("d") + F.col("_d")).alias("d"), F.col("_done").alias("done"))),
                "chains")
        chains = at.filter("done").select("lang", "u", "head", "d")
        # The edges that leave the chain's nodes, in order, behind the one that enters its head.
        leaving = edges.filter("pu").join(chains, (edges["lang"] == chains["lang"]) & (edges["p"] == chains["u"])).select(
            edges["lang"], "head", (F.col("d") + 1).alias("d"), "g", "c")
        heads = chains.filter("d = 0").select("lang", "head")
        first = edges.filter("su AND NOT pu").join(heads, (edges["lang"] == heads["lang"]) & (edges["s"] == heads["head"])).select(
            edges["lang"], "head", F.lit(0).cast("bigint").alias("d"), "g", "c")
        chained = leaving.unionAll(first).groupBy("lang", "head").agg(
            F.array_sort(F.collect_list(F.struct("d", F.when(F.col("d") == 0, F.col("g")).otherwise(_last("g", 1)).alias("w")))
                         ).alias("ws"), F.max("c").alias("c"))
        long_ = chained.select("lang", F.array_join("ws.w", " ").alias("path"), (F.size("ws") + 3).cast("bigint").alias("n_words"), "c")
        rings = at.filter("NOT done").select("lang", F.col("u").alias("p"))
        alone = edges.filter("NOT pu AND NOT su").unionAll(edges.join(rings, ["lang", "p"], "left_semi").select(edges.columns))
        return long_.unionAll(alone.select("lang", F.col("g"), F.lit(WORDS).cast("bigint"), "c"))

    def phrases(self) -> DataFrame:
        """``lang``, ``k``, ``phrase``, ``a``: all phrases of 2 to 4 words with ``min_count`` places."""
        ws = F.split("path", " ")
        four = self.paths().select("lang", ws.alias("ws"), "n_words", "c").select(
            "lang", "ws", "c", F.explode(F.sequence(F.lit(1), F.col("n_words").cast("int") - 3)).alias("i"))
        return (
            four.select("lang", F.lit(4).alias("k"), F.array_join(F.slice("ws", F.col("i"), 4), " ").alias("phrase"), F.col("c").alias("a"))
            .unionAll(self.nodes.select("lang", F.lit(3), "g", "f")).unionAll(self.pairs.select("lang", F.lit(2), "g", "f")))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 inside_percent: int = INSIDE_PERCENT, first: int | None = FIRST, most_counters: int = MOST_COUNTERS) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of the phrases of 2 to 4 words.

    A phrase with ``a`` places, cut after its first words into parts with ``l`` and ``r`` places, scores
    floor(2000000 a / (l + r)); its lowest cut counts, the earliest among equals. Phrases inside a longer one that has
    ``inside_percent`` of their places go. The ``first`` of each language are listed (None: all), ties by places, then
    by the phrase's bytes.
    """
    graph = Graph(docs, text_col, lang_col, min_count, most_counters)
    found = scratch(graph.phrases(), "phrases")
    counts = scratch(found.select("lang", F.col("phrase").alias("g"), F.col("a").alias("f")).unionAll(
        graph.singles.select("lang", "g", "f")), "counts")
    cuts = found.select("lang", "phrase", "a", F.inline(F.filter(F.array(*[
        F.when(F.col("k") > j, F.struct(F.lit(j).alias("j"), _first("phrase", j).alias("x"),
                                        F.call_function("substring_index", F.col("phrase"), F.lit(" "), F.lit(j) - F.col("k")).alias("y")))
        for j in range(1, WORDS)]), lambda c: c.isNotNull())))
    scored = (
        cuts.join(counts.select("lang", F.col("g").alias("x"), F.col("f").alias("l")), ["lang", "x"])
        .join(counts.select("lang", F.col("g").alias("y"), F.col("f").alias("r")), ["lang", "y"])
    )
    # Decimals: the product may pass 64 bits.
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    scored = scored.select("lang", "phrase", "a", "j", "l", "r", (F.lit(2_000_000) * whole("a")).alias("up"),
                           (whole("l") + whole("r")).alias("down")).withColumn("score", F.expr("up div down"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "j", "l", "r")).alias("b"))
    # The parts of longer phrases.
    parts = [(k, m, i) for k in (3, 4) for m in range(2, k) for i in range(k - m + 1)]
    inside = found.filter("k > 2").select("lang", "a", F.explode(F.filter(F.array(*[
        F.when(F.col("k") == k, _last(_first("phrase", i + m), m)) for k, m, i in parts]), lambda c: c.isNotNull())).alias("phrase"))
    longest = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longest, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100).cast("decimal(19,0)") * whole("longer") < F.lit(inside_percent) * whole("a")))
    listed = kept.select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = listed.withColumn("rank", F.row_number().over(order).cast("bigint"))
    if first is not None:
        ranked = ranked.filter(F.col("rank") <= first)
    return ranked.join(F.broadcast(graph.words) if first is not None else graph.words, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
