"""Order-dependent work without one task per series.

A series may hold a third of all rows, so a window partitioned by series alone
does not scale. Rows are cut into slices of even size by (series, order) instead,
which splits a long series over many slices. The cuts are fixed before any row
moves, by a sample that is settled first, so a row's slice is a property of the row
and recomputing it changes nothing. Full rows are shuffled once, by slice, and
sorted once; all windows within slices are planned on that order. What slices need
from each other travels in a table with at most two rows per slice, small enough to
broadcast by construction.

``order_by`` must end in a unique column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wattspan.functions.columns import qcol, qcols, require, set_columns
from wattspan.operators.small import checkpointed, join_settled, null_safe_join, settled

SLICE_BYTES = 64 << 20
SLICES_PER_TASK = 4
SAMPLES_PER_SLICE = 16
LEAST_SAMPLES = 4096
MOST_SAMPLES = 1_000_000
_HASHES = 1 << 30
_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_FORMATS = {"timestampFormat": _TIME, "timestampNTZFormat": _TIME}


def slice_count(df: DataFrame, rows: int) -> int:
    """Slices of about ``SLICE_BYTES`` by counted rows; at least a few for each of the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * SLICES_PER_TASK
    return max(least, -(-rows * df._jdf.schema().defaultSize() // SLICE_BYTES))


def _point(by: list[str]) -> Column:
    return F.struct(*[qcol(c).alias(f"c{i}") for i, c in enumerate(by)])


def slicing(df: DataFrame, by: list[str], slices: int | None = None) -> tuple[Column, int]:
    """The slice number of a row, 0 to n - 1 in the order of ``by``, and n.

    Rows are counted, and a sample by hash gives the bounds; the number is found among them by halving steps. Both
    passes read the columns of ``by`` only. The sample follows the slices up to ``MOST_SAMPLES``, as bounds only set how
    evenly rows are cut. One bound per slice comes to the driver, as in Spark's own range shuffle.
    """
    rows = df.count()
    n = (slices or slice_count(df, rows)) if rows else 1
    if n == 1:
        return F.lit(0), 1
    share = min(1.0, min(max(LEAST_SAMPLES, n * SAMPLES_PER_SLICE), MOST_SAMPLES) / rows)
    picked = df.filter(F.pmod(F.xxhash64(*qcols(by)), F.lit(_HASHES)) < F.lit(int(share * _HASHES)))
    sample = picked.agg(F.array_sort(F.collect_list(_point(by))).alias("ps"))
    at = lambda i: F.get("ps", F.floor(i * F.size("ps") / F.lit(n)).cast("int"))
    bounds = sample.select(F.transform(F.sequence(F.lit(1), F.lit(n - 1)), at).alias("b"))
    kind = bounds.schema["b"].dataType.simpleString()
    # What the text form rounds moves a bound, not a row.
    text = bounds.select(F.to_json("b", _FORMATS)).first()[0]
    # Folded to a constant array when planned.
    constant = F.from_json(F.lit(text), kind, _FORMATS)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((n - 1).bit_length()))])
    point = _point(by)
    go = lambda pos, k: (pos + k <= n - 1) & (F.get(constant, pos + k - 1) <= point)
    return F.aggregate(steps, F.lit(0), lambda pos, k: F.when(go(pos, k), pos + k).otherwise(pos)), n


def arrange(df: DataFrame, order_by: list[str], keys: list[str] = (), slices: int | None = None) -> DataFrame:
    """Rows shuffled by ``_slice`` and sorted in it, with ``_idx``, the place of a row in its slice."""
    require(df, [*keys, *order_by])
    by = [*keys, *order_by]
    number, n = slicing(df, by, slices)
    tasks = -(-n // SLICES_PER_TASK)
    cut = df.withColumn("_slice", number)
    fixed = tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moved = cut.repartition(tasks, "_slice") if fixed else cut.repartition("_slice")
    return moved.sortWithinPartitions("_slice", *qcols(by)).withColumn(
        "_idx", F.row_number().over(W.partitionBy("_slice").orderBy(*qcols(by))) - 1)


def _here(keys: list[str], order_by: list[str], descending: bool = False):
    """Over a series' rows in a slice, on the order that ``arrange`` has made (or its reverse)."""
    cols = qcols(order_by)
    return W.partitionBy("_slice", *qcols(keys)).orderBy(*[c.desc() for c in cols] if descending else cols)


def _offsets(arranged: DataFrame) -> DataFrame:
    """``_off``, the rows before each slice: one row per slice."""
    sizes = arranged.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))


def with_position(df: DataFrame, order_by: list[str], keys: list[str] = (), name: str = "pos",
                  slices: int | None = None) -> DataFrame:
    """Adds the 0-based position of each row in its series. The rows are checkpointed."""
    keys = list(keys)
    arranged = checkpointed(arrange(df, order_by, keys, slices))
    numbered = arranged.join(F.broadcast(_offsets(arranged)), "_slice").withColumn("_g", F.col("_off") + F.col("_idx")).drop("_off")
    if not keys:
        return numbered.withColumnRenamed("_g", name).drop("_slice", "_idx")
    starts, rows = settled(numbered.groupBy(*qcols(keys)).agg(F.min("_g").alias("_start")))
    return (
        join_settled(numbered, starts, rows, keys)
        .withColumn(name, F.col("_g") - F.col("_start"))
        .drop("_g", "_start", "_slice", "_idx")
    )


def _carry_window(keys: list[str], descending: bool = False):
    """Over the per-slice table: at most one row per slice and series."""
    return W.partitionBy(*qcols(keys)).orderBy(F.desc("_slice") if descending else F.asc("_slice"))


def running(df: DataFrame, sums: list[str], order_by: list[str], keys: list[str] = (),
            previous: str | None = None, slices: int | None = None) -> DataFrame:
    """Adds ``<c>_cum`` (inclusive running sum) per series.

    ``previous`` names an order column whose value in the preceding row is added
    as ``<c>_before``.
    """
    keys = list(keys)
    here = _here(keys, order_by)
    new = {f"{c}_cum": F.sum(qcol(c)).over(here.rowsBetween(W.unboundedPreceding, 0)) for c in sums}
    if previous:
        new[f"{previous}_before"] = F.lag(qcol(previous)).over(here)
    summed = checkpointed(set_columns(arrange(df, order_by, keys, slices), new))
    aggs = [F.sum(qcol(c)).alias(f"_s_{c}") for c in sums]
    if previous:
        aggs.append(F.max(qcol(previous)).alias("_p"))
    per = summed.groupBy(*qcols(keys), "_slice").agg(*aggs)
    before = _carry_window(keys).rowsBetween(W.unboundedPreceding, -1)
    carry_cols = [F.sum(f"_s_{c}").over(before).alias(f"_c_{c}") for c in sums]
    if previous:
        carry_cols.append(F.max("_p").over(before).alias("_c_prev"))
    carry = per.select(*qcols(keys), "_slice", F.row_number().over(_carry_window(keys)).alias("_rn"), *carry_cols)
    # Only a series that began in an earlier slice carries anything: one per slice.
    carry = carry.filter("_rn > 1").drop("_rn")
    out = null_safe_join(summed, F.broadcast(carry), [*keys, "_slice"], "left")
    added: dict[str, Column] = {f"{c}_cum": qcol(f"{c}_cum") + F.coalesce(qcol(f"_c_{c}"), F.lit(0)) for c in sums}
    if previous:
        added[f"{previous}_before"] = F.coalesce(qcol(f"{previous}_before"), F.col("_c_prev"))
    return set_columns(out, added).drop("_slice", "_idx", "_c_prev", *[f"_c_{c}" for c in sums])


def neighbours(df: DataFrame, cols: list[str], order_by: list[str], keys: list[str] = (),
               slices: int | None = None) -> DataFrame:
    """Adds ``_g`` and, per column, the nearest non-null at or before / at or after.

    ``<c>_prev`` and ``<c>_next`` are structs (at, val), where ``at`` is a row
    number in the whole order, so differences within a series are row distances.
    The nearest values within a slice are found in the stage that sorts it; the rows
    are checkpointed once, with them.
    """
    keys = list(keys)
    point = lambda c: F.when(qcol(c).isNotNull(), F.struct(F.col("_idx").cast("bigint").alias("at"), qcol(c).alias("val")))
    # The look-ahead runs over the reverse order: Spark rescans a frame that ends
    # at UNBOUNDED FOLLOWING for every row.
    sides = {"prev": _here(keys, order_by), "next": _here(keys, order_by, descending=True)}
    near = {f"{c}_{side}": F.last(point(c), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
            for side, w in sides.items() for c in cols}
    placed = checkpointed(set_columns(arrange(df, order_by, keys, slices), near))
    offsets = F.broadcast(_offsets(placed))
    moved = lambda c: F.when(qcol(c).isNotNull(), F.struct((qcol(c).getField("at") + F.col("_off")).alias("at"), qcol(c).getField("val").alias("val")))
    # Structs compare by row number first, so max/min give the last/first point.
    per = placed.groupBy(*qcols(keys), "_slice").agg(
        *[F.max(qcol(f"{c}_prev")).alias(f"_l_{c}") for c in cols], *[F.min(qcol(f"{c}_next")).alias(f"_f_{c}") for c in cols],
    ).join(offsets, "_slice")
    per = per.select(*qcols(keys), "_slice", *[moved(f"_{p}_{c}").alias(f"_{p}_{c}") for c in cols for p in "lf"])
    before = _carry_window(keys).rowsBetween(W.unboundedPreceding, -1)
    after = _carry_window(keys, descending=True).rowsBetween(W.unboundedPreceding, -1)
    carry = per.select(
        *qcols(keys), "_slice",
        *[F.max(qcol(f"_l_{c}")).over(before).alias(f"_cl_{c}") for c in cols],
        *[F.min(qcol(f"_f_{c}")).over(after).alias(f"_cf_{c}") for c in cols],
    )
    # Only series that span slices carry anything: the first and last of each slice.
    any_carry = None
    for c in cols:
        for p in ("cl", "cf"):
            has = qcol(f"_{p}_{c}").isNotNull()
            any_carry = has if any_carry is None else any_carry | has
    out = null_safe_join(placed.join(offsets, "_slice"), F.broadcast(carry.filter(any_carry)), [*keys, "_slice"], "left")
    new: dict[str, Column] = {"_g": F.col("_off") + F.col("_idx")}
    for c in cols:
        new[f"{c}_prev"] = F.coalesce(moved(f"{c}_prev"), qcol(f"_cl_{c}"))
        new[f"{c}_next"] = F.coalesce(moved(f"{c}_next"), qcol(f"_cf_{c}"))
    out = set_columns(out, new)
    return out.drop("_slice", "_idx", "_off", *[f"_{p}_{c}" for c in cols for p in ("cl", "cf")])


def row_at(df: DataFrame, by: list[str], ranks: Column) -> DataFrame:
    """The rows at some 0-based ranks in the order of ``by``: ``ranks`` is an array over ``n``, the number of rows.

    Gives ``place`` (in the array) and ``point`` (a struct of ``by``). Rows are counted per slice, and only those of the
    slices that hold a wanted rank are sorted.
    """
    number, _ = slicing(df, by)
    keyed = df.select(_point(by).alias("point"), number.alias("_slice"))
    sizes = keyed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_c"))
    # One row per slice.
    upto = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, 0)
    summed = sizes.withColumn("_end", F.sum("_c").over(upto)).withColumn("n", F.sum("_c").over(W.partitionBy()))
    wanted = summed.select("_slice", "_c", "_end", F.posexplode(ranks).alias("place", "rank")).filter(
        (F.col("rank") < F.col("_end")) & (F.col("rank") >= F.col("_end") - F.col("_c")))
    wanted = wanted.select("_slice", "place", (F.col("rank") - F.col("_end") + F.col("_c")).alias("_want"))
    # As many rows as ranks.
    near = keyed.join(F.broadcast(wanted), "_slice")
    rank = F.row_number().over(W.partitionBy("_slice", "place").orderBy("point")) - 1
    return near.withColumn("_rk", rank).filter(F.col("_rk") == F.col("_want")).select("place", "point")


def in_blocks(df: DataFrame, pos: str, before: int, after: int = 0, block: int | None = None) -> DataFrame:
    """Splits series into blocks for bounded frames.

    Rows within reach of a block edge are copied to the neighbouring block, so a
    frame of ``before`` rows back and ``after`` rows ahead is complete for every
    row with ``_home`` true. Use windows over (keys, ``_block``), then keep
    ``_home`` rows.
    """
    size = block or max(65_536, 8 * (before + after))
    p = qcol(pos)
    first = F.greatest(F.floor((p - after) / size), F.lit(0))
    last = F.floor((p + before) / size)
    return df.withColumn("_block", F.explode(F.sequence(first, last))).withColumn(
        "_home", F.floor(p / size) == F.col("_block")
    )
