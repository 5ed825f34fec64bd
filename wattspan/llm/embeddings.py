"""Near-duplicate vectors of one label by Euclidean p-stable hashing and exact cosines.

1. *Classes.* Equal vectors of one label form a class (by a SHA-256 of their
   components, summed on the map side first), so copies are never expanded.
2. *Tables.* A normalised vector v falls into the bucket floor((a.v + b) / width)
   of each of ``k`` Gaussian projections a; the ``k`` numbers together are its
   place in one of several tables. The width is ``WIDTHS`` times the distance at
   the threshold. ``k`` grows with the logarithm of the largest label, so that
   vectors at ``far`` cosine meet by chance less than once a table; the number of
   tables follows from ``k``, so that a pair just at the threshold shares no
   bucket with probability ``miss`` at most (closer pairs: less).
3. *Cells.* Vectors that are alone in their bucket stay where they are. The
   others meet in a cell, or, in buckets over ``block`` members, in a cell for
   each two of the bucket's salted blocks: no bucket is capped, and none is one
   task. A pair counts in the first table that brings it together.
4. *Check.* A cell computes cosines in double precision. What leaves it is one row
   per vector: its number of links, and an edge of a spanning forest of them.
   Counting the links of a group of n vectors that are all near takes n^2 cosines
   (dense products in the task), but never rows for its pairs.

Vectors that are null, zero, or hold null or non-finite components, and vectors
without a label, are linked with nothing. Vectors of unlike lengths are never
near. Rows without an id come back with a null component, not kept; they count as
links of others. Rows that share an id are vectors of their own, and so are exact
copies. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import qcol, require
from wattspan.llm.batches import mix
from wattspan.llm.components import components
from wattspan.llm.frames import scratch

THRESHOLD = 0.98
FAR = 0.3
MISS = 0.005
WIDTHS = 8.0
BLOCK = 1024
SMALL = 16
SEED = 20

_U = np.uint64


def same_bucket(distance: float, width: float) -> float:
    """Probability that one quantised Gaussian projection joins two points."""
    r = width / distance
    return 1 - 2 * NormalDist().cdf(-r) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(rows: int, threshold: float = THRESHOLD, far: float = FAR, miss: float = MISS) -> tuple[int, int, float]:
    """Projections per table, tables, and width, for ``rows`` vectors of one label."""
    near = math.sqrt(2 - 2 * threshold)
    width = WIDTHS * near
    k = max(4, math.ceil(math.log(max(rows, 2)) / -math.log(same_bucket(math.sqrt(2 - 2 * far), width))))
    return k, max(1, math.ceil(math.log(miss) / math.log(1 - same_bucket(near, width) ** k))), width


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the vectors and all components."""
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0)
    offsets = column.offsets.to_numpy().astype(np.int64)
    return np.diff(offsets), column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of norm one; scaled first, so that squares cannot overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _places(k: int, tables: int, width: float):
    """Adds ``places``: one 64-bit number per table."""

    def run(batches):
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            sizes, flat = _matrix(batch.column("v"))
            at = np.cumsum(sizes) - sizes
            places = np.zeros((len(sizes), tables), _U)
            for dim in np.unique(sizes):
                if dim not in drawn:
                    draw = np.random.default_rng([SEED, int(dim)])
                    drawn[dim] = draw.standard_normal((int(dim), k * tables)), draw.uniform(0, width, k * tables)
                a, b = drawn[dim]
                rows = np.flatnonzero(sizes == dim)
                for lo in range(0, len(rows), 1024):
                    some = rows[lo:lo + 1024]
                    cells = np.floor((_unit(flat[at[some][:, None] + np.arange(dim)]) @ a + b) / width).astype(np.int64).view(_U)
                    h = np.full((len(some), tables), _U(dim))
                    for j in range(k):
                        h = mix(h * _U(0xD6E8FEB86659FD93) + cells[:, j::k])
                    places[some] = h
            flat_places = pa.array(places.reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * tables), flat_places)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "places"])

    return run


def _lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row the smallest row that links reach."""
    low = np.arange(n)
    while len(a):
        least = np.minimum(low[a], low[b])
        after = low.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if (after == low).all():
            break
        low = after
    return low


def _compare(threshold: float):
    """Cells in order: per class its links, weighted by the partners' copies, and the class its links lead to."""

    def links(cell, rows):
        """Pairs of one cell that are near and have not met in an earlier table."""
        unit, table, block, places = rows
        low, high = cell
        left = np.flatnonzero(block == low)
        right = np.flatnonzero(block == high) if low != high else left
        found_a, found_b = [], []
        for lo in range(0, len(left), 512):
            part = left[lo:lo + 512]
            a, b = np.nonzero(unit[part] @ unit[right].T >= threshold)
            a, b = part[a], right[b]
            if low == high:
                a, b = a[a < b], b[a < b]
            if table and len(a):
                # A bounded number of pairs at a time.
                new = np.concatenate([~(places[a[i:i + 65536], :table] == places[b[i:i + 65536], :table]).any(axis=1)
                                      for i in range(0, len(a), 65536)])
                a, b = a[new], b[new]
            found_a.append(a), found_b.append(b)
        return np.concatenate(found_a or [np.zeros(0, np.int64)]), np.concatenate(found_b or [np.zeros(0, np.int64)])

    def small(sizes, flat, first, count, table, block, low, high, places):
        """Near pairs of all cells of few members at once, by their distance in the cell."""
        at = np.cumsum(sizes) - sizes
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for gap in range(1, int(count.max()) if len(count) else 0):
            cells = count > gap
            starts = np.repeat(first[cells], count[cells] - gap)
            a = starts + np.arange(len(starts)) - np.repeat(np.cumsum(count[cells] - gap) - (count[cells] - gap), count[cells] - gap)
            b = a + gap
            fits = (sizes[a] == sizes[b]) & ((low[a] == high[a]) | (block[a] != block[b]))
            a, b = a[fits], b[fits]
            for lo in range(0, len(a), 8192):
                x, y = a[lo:lo + 8192], b[lo:lo + 8192]
                new = ~((places[x] == places[y]) & (np.arange(places.shape[1]) < table[x][:, None])).any(axis=1)
                x, y = x[new], y[new]
                for dim in np.unique(sizes[x]):
                    own = sizes[x] == dim
                    p, q = x[own], y[own]
                    cos = (_unit(flat[at[p][:, None] + np.arange(dim)]) * _unit(flat[at[q][:, None] + np.arange(dim)])).sum(axis=1)
                    found_a.append(p[cos >= threshold]), found_b.append(q[cos >= threshold])
        return np.concatenate(found_a), np.concatenate(found_b)

    def run(batches):
        rest = None
        cols = ("label", "table", "place", "low", "high")

        def work(batch: pa.Table):
            keys = [batch.column(c).to_numpy() for c in cols]
            new = np.ones(len(batch), bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in keys], axis=0)
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(batch)))
            cid, copies, block = (batch.column(c).to_numpy() for c in ("cid", "copies", "block"))
            sizes, flat = _matrix(batch.column("v").combine_chunks())
            places = batch.column("places").combine_chunks().flatten().to_numpy().reshape(len(batch), -1)
            at = np.cumsum(sizes) - sizes
            few = count <= SMALL
            pairs = [small(sizes, flat, first[few], count[few], keys[1], block, keys[3], keys[4], places)]
            for lo, n in zip(first[~few], count[~few]):
                for dim in np.unique(sizes[lo:lo + n]):
                    own = lo + np.flatnonzero(sizes[lo:lo + n] == dim)
                    unit = _unit(flat[at[own][:, None] + np.arange(dim)])
                    a, b = links((keys[3][lo], keys[4][lo]), (unit, int(keys[1][lo]), block[own], places[own]))
                    pairs.append((own[a], own[b]))
            a, b = (np.concatenate(x) for x in zip(*pairs))
            total = np.zeros(len(batch), np.int64)
            np.add.at(total, a, copies[b])
            np.add.at(total, b, copies[a])
            to = _lowest(len(batch), a, b)
            some = np.flatnonzero(total)
            return pa.RecordBatch.from_pydict({
                "cid": pa.array(cid[some]), "links": pa.array(total[some]), "to": pa.array(cid[to[some]])})

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            # The last cell may go on.
            keys = [table.column(c).to_numpy() for c in cols]
            last = np.flatnonzero(np.any([x != x[-1] for x in keys], axis=0)) if len(table) else np.zeros(0, int)
            cut = int(last[-1]) + 1 if len(last) else 0
            rest = table.slice(cut)
            if cut:
                yield work(table.slice(0, cut))
        if rest is not None and len(rest):
            yield work(rest)

    return run


def usable(vector: Column, label: Column) -> Column:
    """True for a labelled vector whose components are all numbers and not all zero."""
    numbers = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & numbers & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD, far: float = FAR, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """Per row: the id, ``n_links`` (other rows near it), ``component_id`` (smallest id reachable) and ``kept``."""
    require(vectors, [id_col, vector_col, label_col])
    slim = vectors.select(qcol(id_col).cast("bigint").alias("_id"), qcol(label_col).cast("bigint").alias("label"),
                          qcol(vector_col).alias("v"))
    # The sign of zero is no difference.
    even = F.transform("v", lambda x: F.when(x == 0, F.abs(x)).otherwise(x).cast("string"))
    digest = F.unhex(F.sha2(F.array_join(even, ","), 256))
    slim = slim.withColumn("digest", F.when(usable(F.col("v"), F.col("label")), digest))
    equal = slim.filter("digest IS NOT NULL").groupBy("label", "digest").agg(
        F.min("_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    classes = scratch(equal.withColumn("cid", F.monotonically_increasing_id()), "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    k, tables, width = plan_tables(largest, threshold, far, miss)
    kind = classes.schema["v"].dataType.simpleString()
    placed = scratch(
        classes.select("cid", "label", "copies", "v").mapInArrow(
            _places(k, tables, width), f"cid bigint, label bigint, copies bigint, v {kind}, places array<bigint>"),
        "places")
    members = placed.select("cid", "label", F.posexplode("places").alias("table", "place"))
    crowded = members.groupBy("label", "table", "place").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = members.join(crowded, ["label", "table", "place"]).withColumn("blocks", F.ceil(F.col("size") / block))
    own = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    met = met.select("cid", "table", "place", own.alias("block"),
                     F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
    cells = met.join(placed, "cid").select(
        "label", "table", "place", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "cid", "copies", "block", "v", "places")
    keys = ["label", "table", "place", "low", "high"]
    found = scratch(cells.repartition(*keys).sortWithinPartitions(*keys, "cid").mapInArrow(
        _compare(threshold), "cid bigint, links bigint, to bigint"), "links")
    counted = found.groupBy("cid").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("cid").alias("a"), F.col("to").alias("b"))).select(F.col("id").alias("cid"), "component")
    joined = scratch(classes.join(counted, "cid", "left").join(labels, "cid", "left").select(
        "label", "digest", "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "cid").alias("component")), "joined")
    first = joined.groupBy("component").agg(F.min("rep").alias("c"))
    named = joined.join(first, "component").select("label", "digest", "n_links", "c")
    out = slim.select("_id", "label", "digest").join(named, ["label", "digest"], "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("c", "_id"))
    return out.select(F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("_id"), F.lit(False)).alias("kept"))
