"""Mutual information of two measurements by distances to the k-th neighbour.

The estimate of Kraskov, Stögbauer and Grassberger: for each row the distance to
its k-th neighbour in both columns together (the larger of the two differences,
each column in units of its own deviation), then the number of rows nearer than
that in each column alone.

* *Distances.* Rows with equal pairs are one point with a weight. The plane is cut
  into boxes of about ``BOX`` points by a tree of medians over a bounded sample,
  cutting the wider side first, so dense places get small boxes. A point's own box
  gives an upper bound; only the points whose square of that size leaves the box
  visit the boxes it meets, once: nothing nearer can lie elsewhere. The sample's
  bound makes boxes grow beyond some 10^8 points.
* *Counts.* Rows nearer in one column are the difference of two ranks, taken by one
  running sum over the column's values and the squares' edges together.

No pair of rows is ever formed between tasks, and no box or value is one task's
burden: hot values are weights. Inside a box distances are numpy on Arrow columns.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import numeric_columns, number, qcol, require
from wattspan.operators.order import running
from wattspan.operators.small import checkpointed

BOX = 512
SAMPLE = 2_000_000
# Distances that differ by less, as a share, are equal: differences of equal steps are rounded each in its own way.
ALIKE = 1e-9


def digamma(n: Column) -> Column:
    """Of a whole number from 1 on: the series from 8 upward, steps below."""
    steps = F.lit(0.0)
    for i in range(8):
        steps = steps + F.when(n + i < 8, 1 / (n + i)).otherwise(0.0)
    x = F.greatest(n, F.lit(8)).cast("double")
    y = 1 / (x * x)
    return F.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132)))) - steps


class Boxes:
    """A tree of cuts through the plane; ``place`` and ``meets`` work on arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray, boxes: int, least: int):
        self.axis, self.cut, self.child, self.boxes, self.least = [], [], [], 0, least
        self._grow(np.stack([x, y]), boxes)

    def _grow(self, points: np.ndarray, boxes: int) -> int:
        """Number of the node: negative for a box."""
        spans = points.max(axis=1) - points.min(axis=1) if points.shape[1] else np.zeros(2)
        for axis in np.argsort(-spans):
            values = points[axis]
            cut = np.median(values) if boxes > 1 and len(values) > 1 else np.nan
            # Equal values stay on one side.
            low = values < cut
            if boxes > 1 and min(low.sum(), (~low).sum()) >= self.least:
                node = len(self.axis)
                self.axis.append(int(axis)), self.cut.append(float(cut)), self.child.append((0, 0))
                share = min(max(round(boxes * low.mean()), 1), boxes - 1)
                self.child[node] = (self._grow(points[:, low], share), self._grow(points[:, ~low], boxes - share))
                return node
        self.boxes += 1
        return -self.boxes

    def meets(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, box) of all boxes that the rectangles lo..hi (2 x n) touch."""
        rows, boxes = [], []
        todo = [(0 if self.axis else -1, np.arange(lo.shape[1]))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                rows.append(at), boxes.append(np.full(len(at), -node))
                continue
            axis, cut = self.axis[node], self.cut[node]
            todo.append((self.child[node][0], at[lo[axis, at] < cut]))
            todo.append((self.child[node][1], at[hi[axis, at] >= cut]))
        return np.concatenate(rows or [np.zeros(0, int)]), np.concatenate(boxes or [np.zeros(0, int)])

    def place(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        point = np.stack([x, y])
        rows, boxes = self.meets(point, point)
        out = np.zeros(len(x), np.int64)
        out[rows] = boxes
        return out


def _kth(px, py, x, y, w, k: int, bound: np.ndarray) -> np.ndarray:
    """Distance from each (px, py) to its k-th neighbour among weighted points; at most ``bound``. A row is its own first."""
    out = bound.copy()
    for lo in range(0, len(px), 256):
        part = slice(lo, lo + 256)
        d = np.maximum(np.abs(px[part, None] - x), np.abs(py[part, None] - y))
        take = min(k + 1, d.shape[1])
        near = np.argpartition(d, take - 1, axis=1)[:, :take]
        near_d = np.take_along_axis(d, near, 1)
        order = np.argsort(near_d, axis=1, kind="stable")
        near_d, weight = np.take_along_axis(near_d, order, 1), np.cumsum(w[np.take_along_axis(near, order, 1)], axis=1)
        enough = weight >= k + 1
        has = enough.any(axis=1)
        first = enough.argmax(axis=1)
        out[part][has] = np.minimum(out[part][has], near_d[np.flatnonzero(has), first[has]])
    return out


def _radii(points: DataFrame, k: int, box: int, sample: int) -> DataFrame:
    """``x``, ``y``, ``w`` and ``r``, the distance to the k-th neighbour."""
    spark = points.sparkSession
    many = points.count()
    # A bounded sample by hash; it only shapes the boxes, and each holds enough of it to bound every distance.
    share = min(1.0, min(sample / max(many, 1), 8 * (k + 1) / box))
    picked = points.filter(F.pmod(F.xxhash64("x", "y"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("x", "y").toPandas()
    boxes = Boxes(picked["x"].to_numpy(float), picked["y"].to_numpy(float), max(1, min(-(-many // box), len(picked) // (4 * (k + 1)))), k + 1)
    shared = spark.sparkContext.broadcast(boxes)
    infinite = float("inf")

    def placed(batches):
        for b in batches:
            x, y = b.column("x").to_numpy(), b.column("y").to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.place(x, y))], [*b.schema.names, "box"])

    homes = checkpointed(points.mapInArrow(placed, "x double, y double, w bigint, box bigint"))

    def own(table: pa.Table) -> pa.Table:
        x, y, w = (table.column(c).to_numpy() for c in ("x", "y", "w"))
        r = _kth(x, y, x, y, w, k, np.full(len(x), infinite))
        return pa.table({"x": x, "y": y, "w": w, "box": table.column("box"), "r": r})

    first = checkpointed(homes.groupBy("box").applyInArrow(own, "x double, y double, w bigint, box bigint, r double"))

    def visits(batches):
        for b in batches:
            x, y, r = (b.column(c).to_numpy() for c in ("x", "y", "r"))
            point = np.stack([x, y])
            rows, to = shared.value.meets(point - r, point + r)
            other = to != b.column("box").to_numpy()[rows]
            rows, to = rows[other], to[other]
            yield pa.RecordBatch.from_pydict({"x": x[rows], "y": y[rows], "r": r[rows], "box": to})

    asked = first.mapInArrow(visits, "x double, y double, r double, box bigint")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        x, y, r = (left.column(c).to_numpy() for c in ("x", "y", "r"))
        px, py, w = (right.column(c).to_numpy() for c in ("x", "y", "w"))
        rows, near, weight = [], [], []
        for lo in range(0, len(x), 256):
            d = np.maximum(np.abs(x[lo:lo + 256, None] - px), np.abs(y[lo:lo + 256, None] - py))
            # Only what is nearer than the bound can change it, and the nearest k of a box are enough.
            take = min(k, d.shape[1])
            if not take:
                break
            best = np.argpartition(d, take - 1, axis=1)[:, :take]
            dist = np.take_along_axis(d, best, 1)
            at, col = np.nonzero(dist < r[lo:lo + 256, None])
            rows.append(lo + at), near.append(dist[at, col]), weight.append(w[best[at, col]])
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        rows = cat(rows, int)
        return pa.table({"x": x[rows], "y": y[rows], "d": cat(near, float), "m": cat(weight, np.int64)})

    nearer = asked.groupBy("box").cogroup(homes.groupBy("box")).applyInArrow(answer, "x double, y double, d double, m bigint")

    # The own box's k nearest again, for the points that visited others: both together decide.
    touched = nearer.select("x", "y").distinct()

    def again(table: pa.Table) -> pa.Table:
        x, y, w, r = (table.column(c).to_numpy() for c in ("x", "y", "w", "r"))
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        at = np.flatnonzero(asks)
        rows, near, weight = [], [], []
        for lo in range(0, len(at), 256):
            part = at[lo:lo + 256]
            d = np.maximum(np.abs(x[part, None] - x), np.abs(y[part, None] - y))
            take = min(k + 1, d.shape[1])
            best = np.argpartition(d, take - 1, axis=1)[:, :take]
            rows.append(np.repeat(part, take)), near.append(np.take_along_axis(d, best, 1).ravel()), weight.append(w[best].ravel())
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        rows = cat(rows, int)
        return pa.table({"x": x[rows], "y": y[rows], "d": cat(near, float), "m": cat(weight, np.int64)})

    marked = first.join(touched.withColumn("asks", F.lit(True)), ["x", "y"], "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    mine = marked.groupBy("box").applyInArrow(again, "x double, y double, d double, m bigint")
    # At most k + 1 rows of each box that a point met.
    lists = nearer.unionByName(mine).groupBy("x", "y").agg(F.array_sort(F.collect_list(F.struct("d", "m"))).alias("ds"))
    reach = F.aggregate("ds", F.struct(F.lit(0).cast("bigint").alias("m"), F.lit(infinite).alias("d")),
                        lambda s, v: F.when(s["m"] >= k + 1, s).otherwise(F.struct((s["m"] + v["m"]).alias("m"), v["d"].alias("d"))),
                        lambda s: s["d"])
    final = first.join(lists.select("x", "y", reach.alias("_r")), ["x", "y"], "left")
    return final.select("x", "y", "w", F.least("r", F.coalesce("_r", "r")).alias("r"))


def _nearer(radii: DataFrame, axis: str) -> DataFrame:
    """Per point the weight of all points nearer than ``r`` in one column (at distance 0 where ``r`` is 0), itself included."""
    # Edges that exclude points at the distance itself: those below the upper edge, less those up to the lower one.
    value, edge = F.col(axis), F.col("r") * (1 - ALIKE)
    rows = radii.select("x", "y", "r", F.col("w"), F.inline(F.array(
        F.struct(value.alias("v"), F.lit(1).alias("kind"), F.col("w").alias("c"), F.lit(0).alias("sign")),
        F.struct((value - edge).alias("v"), F.when(F.col("r") > 0, 2).otherwise(0).alias("kind"), F.lit(0).cast("bigint").alias("c"), F.lit(-1).alias("sign")),
        F.struct((value + edge).alias("v"), F.when(F.col("r") > 0, 0).otherwise(2).alias("kind"), F.lit(0).cast("bigint").alias("c"), F.lit(1).alias("sign")))))
    summed = running(rows, ["c"], ["v", "kind", "x", "y", "sign"])
    return summed.filter("sign <> 0").groupBy("x", "y").agg(F.sum(F.col("sign") * F.col("c_cum")).alias(f"n_{axis}"))


def neighbour_information(df: DataFrame, target: str, features: list[str] | None = None, k: int = 3, box: int = BOX,
                          sample: int = SAMPLE) -> DataFrame:
    """``feature`` and ``mi_score`` (nats, at least 0), highest first.

    Rows with a null or NaN in any of the columns are left out. Columns are divided by their deviation; a constant column
    scores 0, as does a table of ``k`` rows or fewer. Equal pairs are neighbours at distance 0; where a row's k-th
    neighbour lies at 0, the counts are those of equal values.
    """
    names = [c for c in (features or numeric_columns(df)) if c != target]
    require(df, [target, *names])
    known = reduce(and_, [qcol(c).isNotNull() for c in [*names, target]])
    full = checkpointed(df.select(*[number(c).cast("double").alias(c) for c in [*names, target]]).filter(known))
    # One row.
    facts = full.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_pop(qcol(c)).alias(f"s{i}") for i, c in enumerate([*names, target])]).first()
    spread, scores = facts[f"s{len(names)}"], []
    for i, name in enumerate(names):
        if facts["n"] <= k or not facts[f"s{i}"] or not spread:
            scores.append((name, 0.0))
            continue
        points = checkpointed(full.groupBy((qcol(name) / facts[f"s{i}"]).alias("x"), (qcol(target) / spread).alias("y"))
                              .agg(F.count(F.lit(1)).alias("w")))
        radii = checkpointed(_radii(points, k, box, sample))
        near = radii.join(_nearer(radii, "x"), ["x", "y"]).join(_nearer(radii, "y"), ["x", "y"])
        mean = near.agg((F.sum(F.col("w") * (digamma(F.col("n_x")) + digamma(F.col("n_y")))) / F.sum("w")).alias("m"))
        constant = full.sparkSession.range(1).select((digamma(F.lit(facts["n"])) + digamma(F.lit(k))).alias("c"))
        scores.append((name, max(0.0, constant.first()[0] - mean.first()[0])))
    scored = full.sparkSession.createDataFrame(scores, "feature string, mi_score double")
    return scored.orderBy(F.desc("mi_score"), "feature")
