"""Near-duplicate documents by fast similarity sketching.

A document's set holds its distinct shingles of five words (lower-cased A to Z);
with fewer words, the whole sequence is the one shingle. Shingles are 64-bit
hashes. A text without words has an empty set and is linked with nothing.

1. *Sketch.* A sketch has ``COORDINATES`` bins. In each of the first rounds every
   shingle is hashed to one bin and a value; a bin keeps its smallest value of
   the first round that reached it. A document stops when all its bins are full.
   Round ``COORDINATES + k`` puts every shingle into bin k, so all bins fill at
   last. Equal coordinates estimate the Jaccard similarity as tightly as
   independent MinHashes do, at a cost of n + t log t instead of n t.
2. *Classes.* Documents with equal sets form a class; only its smallest id goes
   on, so copies are never expanded.
3. *Banding.* ``BANDS`` bands of ``ROWS`` coordinates name buckets. A pair with
   similarity 0.75 shares no bucket with probability (1 - 0.75^ROWS)^BANDS,
   1e-8 for the defaults.
4. *Clusters.* Members of one bucket are plausible partners unless over
   ``MOST_DIFFERENT_BITS`` of 256 lowest coordinate bits differ (32 are expected
   at the threshold, with a deviation of 5.3, so a similar pair is ruled out with
   probability below 1e-9) or their set sizes rule it out. A bucket gives only
   edges of a spanning forest of that relation, never its pairs. Buckets over
   ``LARGE_BUCKET`` members are joined whole instead. Connected edges are clusters.
5. *Verification.* Full sets of a cluster meet in one cell, or, beyond
   ``BLOCK_SHINGLES``, in a cell for each two of its blocks. A cell compares its
   first set with all others; each set that is not linked to it is compared with
   all as well. So every pair that could join two components is compared, and
   what leaves the cell are the edges of a spanning forest of true links.

There is no cap on buckets, clusters or partners.

Null ids are not allowed to link: such rows come back with a null component.
Repeated rows share their component. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import qcol
from wattspan.llm.batches import IS_SPACE, bounds, lowered, mix, ragged, runs, word_hashes
from wattspan.llm.components import components
from wattspan.llm.frames import by_slice, scratch, texts

SHINGLE = 5
PERCENT = 75
COORDINATES = 256
ROWS = 4
BANDS = 48
MOST_DIFFERENT_BITS = 70
LARGE_BUCKET = 50_000
BLOCK_SHINGLES = 2_000_000

_U = np.uint64
_MOST = _U(0xFFFFFFFFFFFFFFFF)
_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=_U))


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after another, and the texts' offsets in them."""
    low = lowered(data)
    starts, ends = runs(~IS_SPACE[low], off)
    first = bounds(starts, off)
    words = word_hashes(low, starts, ends)
    n = np.diff(first)
    # A shingle is a polynomial of its words' hashes; a short text has one over all its words.
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    at = ragged(first[:-1], count)
    length = np.repeat(np.minimum(n, width), count)
    h = length.astype(_U)
    for k in range(width):
        inside = k < length
        h = np.where(inside, mix(h * _U(0x9E3779B97F4A7C15) + words[np.minimum(at + k, len(words) - 1)]), h) if len(at) else h
    out, sizes = [], []
    ends_ = np.cumsum(count)
    for s, e in zip((ends_ - count).tolist(), ends_.tolist()):
        own = h[s:e]
        own.sort()
        if e - s > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        out.append(own)
        sizes.append(len(own))
    return (np.concatenate(out) if out else h), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def sketches(h: np.ndarray, off: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """One row of t coordinates per set; rows of empty sets mean nothing."""
    n = len(off) - 1
    size = np.diff(off)
    out = np.full((n, t), _MOST, _U)
    shift = _U(64 - (t - 1).bit_length())
    live = np.flatnonzero(size > 0)
    for r in range(2 * t):
        if not len(live):
            break
        own = size[live]
        x = mix(h[ragged(off[live], own)] ^ _SEEDS[r])
        row = np.repeat(np.arange(len(live)), own)
        got = np.full((len(live), t), _MOST, _U)
        if r < t:
            np.minimum.at(got.reshape(-1), row * t + (x >> shift).astype(np.int64), mix(x))
        else:
            got[:, r - t] = np.minimum.reduceat(mix(x), np.cumsum(own) - own)
        mine = out[live]
        out[live] = np.where(mine == _MOST, got, mine)
        live = live[(out[live] == _MOST).any(axis=1)]
    return out


def _describe(batch, lo, hi, data, off):
    """Size, fingerprint, bucket keys and one bit per coordinate of each document."""
    h, at = shingle_sets(data, off)
    sketch = sketches(h, at)
    n = np.diff(at)
    bands = np.arange(BANDS, dtype=_U)
    keys = np.tile(mix(bands + _U(1)), (hi - lo, 1))
    for k in range(ROWS):
        keys = mix(keys ^ sketch[:, k:BANDS * ROWS:ROWS][:, :BANDS])
    bits = np.packbits((sketch & _U(1)).astype(np.uint8), axis=1).view(np.int64)
    # Two sums over the set, each of other hashes of the shingles.
    prints = []
    for seed in (_SEEDS[0], _SEEDS[1]):
        total = np.zeros(len(h) + 1, _U)
        np.cumsum(mix(h * _U(3) + seed), out=total[1:])
        prints.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return {
        "_id": batch.column("_id").slice(lo, hi - lo), "n": n, "p": prints[0], "q": prints[1],
        "keys": pa.FixedSizeListArray.from_arrays(keys.view(np.int64).reshape(-1), BANDS).cast(pa.list_(pa.int64())),
        "bits": pa.FixedSizeListArray.from_arrays(bits.reshape(-1), COORDINATES // 64).cast(pa.list_(pa.int64())),
    }


def _sets(batch, lo, hi, data, off):
    h, at = shingle_sets(data, off)
    own = {c: batch.column(c).slice(lo, hi - lo) for c in ("_id", "cluster", "blocks", "block")}
    return {**own, "shingles": pa.ListArray.from_arrays(at.astype(np.int32), h.view(np.int64))}


class Forest:
    """Union-find over 0 .. n - 1; the root of a tree is its smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def forest_edges(n: int, partners) -> list[tuple[int, int]]:
    """Spanning edges of a symmetric relation; ``partners(i)`` lists those of i.

    The partners of 0 need no look at each other. All others are compared with everything.
    """
    trees, edges = Forest(n), []
    star = set(partners(0).tolist()) | {0}
    edges += [(0, j) for j in sorted(star) if trees.join(0, j)]
    for i in range(n):
        if i not in star:
            edges += [(i, j) for j in partners(i).tolist() if trees.join(i, j)]
    return edges


def _sizes_fit(n: np.ndarray, m: int) -> np.ndarray:
    return np.minimum(n, m) * 100 >= np.maximum(n, m) * PERCENT


def _groups(batches, keys: list[str]):
    """Tables of rows with equal keys; rows arrive in key order."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        new = np.zeros(len(held), bool)
        for k in keys:
            v = held.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        at = [0, *np.flatnonzero(new).tolist()]
        for lo, hi in zip(at, at[1:]):
            yield held.slice(lo, hi - lo)
        held = held.slice(at[-1]) if len(held) else None
    if held is not None and len(held):
        yield held


def _plausible(batches):
    """Spanning edges of the plausible partners in each bucket."""
    a, b = [], []

    def out():
        got = pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        a.clear(), b.clear()
        return got

    for table in _groups(batches, ["key"]):
        ids, n = table.column("_id").to_numpy(), table.column("n").to_numpy()
        # Unsigned: bits are counted of the absolute value.
        bits = table.column("bits").combine_chunks().flatten().to_numpy().view(_U).reshape(-1, COORDINATES // 64)

        def partners(i):
            differ = np.bitwise_count(bits ^ bits[i]).sum(axis=1)
            return np.flatnonzero((differ <= MOST_DIFFERENT_BITS) & _sizes_fit(n, n[i]))

        for i, j in forest_edges(len(ids), partners):
            a.append(ids[i])
            b.append(ids[j])
        if len(a) > 1 << 16:
            yield out()
    yield out()


def _linked(batches):
    """Spanning edges of the true links in each cell."""
    for table in _groups(batches, ["cluster", "low", "high"]):
        ids = table.column("_id").to_numpy()
        lists = table.column("shingles").combine_chunks()
        _, dense = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        n = np.diff(lists.offsets.to_numpy())
        at = np.cumsum(n) - n
        flag = np.zeros(len(dense), bool)

        def partners(i):
            own = dense[at[i]:at[i] + n[i]]
            flag[own] = True
            common = np.add.reduceat(flag[dense], at, dtype=np.int64)
            flag[own] = False
            return np.flatnonzero(common * 100 >= (n + n[i] - common) * PERCENT)

        edges = forest_edges(len(ids), partners)
        yield pa.RecordBatch.from_pydict({
            "a": pa.array([ids[i] for i, _ in edges], pa.int64()), "b": pa.array([ids[j] for _, j in edges], pa.int64())})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept`` (it is that one)."""
    slim = texts(docs, id_col, text_col)
    described = scratch(by_slice(
        slim, _describe, "_id bigint, n bigint, p bigint, q bigint, keys array<bigint>, bits array<bigint>"), "sketches")
    usable = described.filter("n > 0 AND _id IS NOT NULL")
    # Classes of equal sets.
    smallest = usable.groupBy("p", "q", "n").agg(F.min("_id").alias("rep"))
    first = smallest.select(F.col("rep").alias("_id"), "p", "q", "n")
    reps = usable.join(first, ["_id", "p", "q", "n"]).dropDuplicates(["_id", "p", "q", "n"]).drop("p", "q")
    buckets = reps.select("_id", F.explode("keys").alias("key"))
    heads = buckets.groupBy("key").agg(F.min("_id").alias("head"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = scratch(buckets.join(heads, "key"), "shared")
    # Members with the facts to compare them by.
    small = shared.filter(F.col("size") <= LARGE_BUCKET).select("key", "_id").join(reps.select("_id", "n", "bits"), "_id")
    edges = small.select("key", "_id", "n", "bits").repartition("key").sortWithinPartitions("key", "_id").mapInArrow(
        _plausible, "a bigint, b bigint")
    large = shared.filter((F.col("size") > LARGE_BUCKET) & (F.col("_id") != F.col("head")))
    clusters = scratch(components(edges.union(large.select("head", "_id"))), "clusters")
    sized = clusters.join(reps.select(F.col("_id").alias("id"), "n"), "id")
    blocks = sized.groupBy(F.col("component").alias("cluster")).agg(
        F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    placed = clusters.join(blocks, F.col("component") == F.col("cluster")).select(
        F.col("id").alias("_id"), "cluster", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"))
    # One row per id, should rows repeat.
    wanted = slim.join(placed, "_id").dropDuplicates(["_id"])
    sets = by_slice(wanted, _sets, "_id bigint, cluster bigint, blocks bigint, block bigint, shingles array<bigint>")
    cells = sets.select("_id", "shingles", "cluster", "block", F.explode_outer(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")).select(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "_id", "shingles")
    links = cells.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high", "_id").mapInArrow(
        _linked, "a bigint, b bigint")
    labels = components(links)
    named = smallest.join(labels, smallest["rep"] == labels["id"], "left").select(
        "p", "q", "n", F.coalesce("component", "rep").alias("_c"))
    out = described.select("_id", "n", "p", "q").join(named, ["p", "q", "n"], "left")
    component = F.when(F.col("_id").isNull(), None).otherwise(F.coalesce("_c", "_id"))
    return out.select(qcol("_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("_id"), F.lit(False)).alias("kept"))
