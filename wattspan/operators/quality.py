"""Profiles and validations: one aggregate over all columns, then one row per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wattspan.functions.columns import numeric_columns, qcol, qcols, require, rows_of, unpivot
from wattspan.functions.text import lenient_double, lenient_long
from wattspan.operators.quantiles import quantile_row
from wattspan.operators.small import scalar_row


def _pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(0.0))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and share per column, most first; an empty frame gives zeros."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(qcol(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    return rows_of(
        counts,
        [
            [
                ("column", F.lit(c)),
                ("null_count", F.col(f"n{i}")),
                ("null_pct", _pct(F.col(f"n{i}"), F.col("_total"))),
                ("total_rows", F.col("_total")),
            ]
            for i, c in enumerate(df.columns)
        ],
    ).orderBy(F.desc("null_count"), "column")


def compare_null_profiles(dirty: DataFrame, clean: DataFrame) -> DataFrame:
    """Full outer join of two profiles, largest change first."""
    def side(p: DataFrame, name: str) -> DataFrame:
        return p.select(
            "column", F.col("null_count").alias(f"{name}_null_count"), F.col("null_pct").alias(f"{name}_null_pct")
        )

    joined = side(dirty, "dirty").join(side(clean, "clean"), "column", "full_outer").na.fill(0)
    diff = F.col("dirty_null_count") - F.col("clean_null_count")
    return joined.select(
        "*",
        diff.alias("null_count_diff"),
        (F.col("dirty_null_pct") - F.col("clean_null_pct")).alias("null_pct_diff"),
    ).orderBy(F.desc(F.abs("null_count_diff")), "column")


def _parses(c: Column, source: str, target: str) -> Column:
    if source == "string" and target in ("double", "float"):
        return lenient_double(c).isNotNull()
    if source == "string" and target in ("bigint", "int"):
        return lenient_long(c).isNotNull()
    return c.try_cast(target).isNotNull()


def type_report(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Per column: valid / invalid / missing / extra, and how many values do not fit."""
    actual = dict(df.dtypes)
    names = list(expected) + [c for c in df.columns if c not in expected]
    checked = [c for c in names if c in expected and c in actual and expected[c] != actual[c]]
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[
            F.count_if(qcol(c).isNotNull() & ~_parses(qcol(c), actual[c], expected[c])).alias(f"f{i}")
            for i, c in enumerate(checked)
        ],
    )
    rows = []
    for c in names:
        if c not in actual:
            status = "missing"
        elif c not in expected:
            status = "extra"
        else:
            status = "valid" if expected[c] == actual[c] else "invalid"
        failing = F.col(f"f{checked.index(c)}") if c in checked else F.lit(0).cast("bigint")
        rows.append(
            [
                ("column", F.lit(c)),
                ("status", F.lit(status)),
                ("expected_type", F.lit(expected.get(c)).cast("string")),
                ("actual_type", F.lit(actual.get(c)).cast("string")),
                ("failing_values", failing),
                ("total_rows", F.col("_total")),
            ]
        )
    return rows_of(counts, rows)


def compare_type_reports(dirty: DataFrame, clean: DataFrame) -> DataFrame:
    """``issue_introduced`` is true where the dirty set is invalid and the clean one valid."""
    def side(r: DataFrame, name: str) -> DataFrame:
        kept = r.filter(F.col("status").isin("valid", "invalid"))
        return kept.select("column", F.col("status").alias(name))

    joined = side(dirty, "_d").join(side(clean, "_c"), "column", "full_outer")
    is_valid = lambda c: F.coalesce(F.col(c) == "valid", F.lit(False))
    return joined.select(
        "column",
        is_valid("_d").alias("dirty_valid"),
        is_valid("_c").alias("clean_valid"),
        (is_valid("_c") & F.coalesce(F.col("_d") == "invalid", F.lit(False))).alias("issue_introduced"),
    ).orderBy("column")


def compare_schemas(dirty: DataFrame, clean: DataFrame) -> DataFrame:
    """Added, removed, retyped and common columns with both row counts."""
    d, c = dict(dirty.dtypes), dict(clean.dtypes)
    counts = dirty.agg(F.count(F.lit(1)).alias("dirty_rows"))
    clean_rows = clean.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = []
    for name in sorted(set(d) | set(c)):
        if name not in c:
            change = "added"
        elif name not in d:
            change = "removed"
        else:
            change = "common" if d[name] == c[name] else "type_changed"
        rows.append(
            [
                ("column", F.lit(name)),
                ("change", F.lit(change)),
                ("dirty_type", F.lit(d.get(name)).cast("string")),
                ("clean_type", F.lit(c.get(name)).cast("string")),
                ("dirty_rows", F.col("dirty_rows")),
                ("clean_rows", F.col("clean_rows")),
            ]
        )
    return rows_of(counts.withColumn("clean_rows", clean_rows), rows)


def _outside(c: Column, rule: dict) -> Column:
    lo, hi = rule.get("min"), rule.get("max")
    out = F.lit(False)
    if lo is not None:
        out = out | (c < lo)
    if hi is not None:
        out = out | (c > hi)
    return out


def range_report(df: DataFrame, rules: dict[str, dict], examples: int = 5) -> DataFrame:
    """Violations per ruled column, with the smallest distinct offending values.

    Text columns are read leniently as numbers. Percentages are over values that
    are numbers.
    """
    types = dict(df.dtypes)
    num = {c: lenient_double(qcol(c)) if types[c] == "string" else qcol(c).cast("double") for c in rules if c in types}
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(_outside(num[c], rules[c])).alias(f"v{i}") for i, c in enumerate(rules) if c in num],
        *[F.count(num[c]).alias(f"n{i}") for i, c in enumerate(rules) if c in num],
    )
    rows = []
    for i, c in enumerate(rules):
        found = c in num
        v = F.col(f"v{i}") if found else F.lit(0).cast("bigint")
        n = F.col(f"n{i}") if found else F.lit(0).cast("bigint")
        status = F.when(v > 0, "violations_found").otherwise("valid") if found else F.lit("column_not_found")
        rows.append(
            [
                ("column", F.lit(c)),
                ("status", status),
                ("violations", v),
                ("violation_pct", _pct(v, n)),
                ("total_count", n),
                ("min_expected", F.lit(rules[c].get("min")).cast("double")),
                ("max_expected", F.lit(rules[c].get("max")).cast("double")),
            ]
        )
    report = rows_of(counts, rows)
    bad = df.select(*[F.when(_outside(num[c], rules[c]), num[c]).alias(c) for c in num])
    long = unpivot(bad, [], list(num), "column", "value").filter("value IS NOT NULL").distinct()
    # The rank limit is applied inside each task before the shuffle.
    first = W.partitionBy("column").orderBy("value")
    few = (
        long.withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") <= examples)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list("value")).alias("examples"))
    )
    # One row per ruled column on both sides.
    out = report.join(F.broadcast(few), "column", "left")
    return out.withColumn("examples", F.coalesce("examples", F.array().cast("array<double>")))


def compare_range_reports(dirty: DataFrame, clean: DataFrame) -> DataFrame:
    def side(r: DataFrame, name: str) -> DataFrame:
        return r.select(
            "column", F.col("violations").alias(f"{name}_violations"), F.col("violation_pct").alias(f"{name}_pct")
        )

    joined = side(dirty, "dirty").join(side(clean, "clean"), "column", "full_outer").na.fill(0)
    return joined.select(
        "*",
        (F.col("dirty_violations") - F.col("clean_violations")).alias("difference"),
        ((F.col("clean_violations") == 0) & (F.col("dirty_violations") > 0)).alias("issue_introduced"),
    ).orderBy(F.desc("difference"), "column")


def row_errors(df: DataFrame, features: list[str], ranges: dict[str, tuple[float, float]],
               classes: dict[str, list[str]] | None = None) -> DataFrame:
    """Adds ``error``: the first rule a row breaks, or null for a valid row."""
    missing = [c for c in features if c not in df.columns]
    types = dict(df.dtypes)
    rules: list[Column] = []
    if missing:
        rules.append(F.lit(f"Missing features: {sorted(missing)}"))
    for c in (f for f in features if f in types):
        text = types[c] == "string"
        num = lenient_double(qcol(c)) if text else qcol(c).cast("double")
        empty = qcol(c).isNull() | (F.lit(False) if text else F.isnan(num))
        rules.append(F.when(empty, f"Feature '{c}' has null value"))
        if text:
            rules.append(F.when(num.isNull(), f"Feature '{c}' must be numeric"))
        if c in ranges:
            lo, hi = ranges[c]
            rules.append(F.when(~num.between(lo, hi), f"Feature '{c}' out of range [{lo}, {hi}]"))
    for c, allowed in (classes or {}).items():
        rules.append(F.when(~F.coalesce(qcol(c).isin(*allowed), F.lit(False)), f"Feature '{c}' not an allowed class"))
    return df.withColumn("error", F.coalesce(*rules, F.lit(None).cast("string")))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return checked.filter("error IS NULL").drop("error"), checked.filter("error IS NOT NULL")


def invalid_categories(df: DataFrame, column: str, valid: list[str]) -> DataFrame:
    """Values outside the domain with their counts; nulls are not reported."""
    require(df, [column])
    total = df.agg(F.count(F.lit(1))).scalar()
    bad = df.filter(~qcol(column).isin(*valid)).groupBy(qcol(column).alias("invalid_value"))
    counted = bad.agg(F.count(F.lit(1)).alias("invalid_count"))
    return counted.withColumn("total_count", total).withColumn(
        "invalid_pct", F.round(F.col("invalid_count") / F.col("total_count") * 100, 2)
    )


def cleaned_report(cleaned: DataFrame, reference: DataFrame, tolerance: int = 100) -> DataFrame:
    """One row of checks of a cleaned set against a reference set."""
    ctypes, rtypes = dict(cleaned.dtypes), dict(reference.dtypes)
    retyped = sorted(c for c in ctypes if c in rtypes and ctypes[c] != rtypes[c])
    same = set(ctypes) == set(rtypes)
    per_group = cleaned.groupBy(*qcols(cleaned.columns)).agg(F.count(F.lit(1)).alias("_n"))
    nulls = F.lit(0)
    for c in cleaned.columns:
        nulls = nulls + qcol(c).isNull().cast("int")
    ref_rows = reference.agg(F.count(F.lit(1))).scalar()
    base = per_group.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        F.count(F.lit(1)).alias("_distinct"),
        F.coalesce(F.sum(nulls * F.col("_n")), F.lit(0)).alias("null_count"),
    ).withColumn("_ref", ref_rows)
    out = base.select(
        (F.abs(F.col("_rows") - F.col("_ref")) <= tolerance).alias("shape_match"),
        (F.col("_rows") - F.col("_ref")).alias("row_count_diff"),
        F.lit(same).alias("schema_match"),
        "null_count",
        (F.col("_rows") - F.col("_distinct")).alias("duplicate_count"),
        F.lit(len(retyped)).cast("bigint").alias("type_mismatches"),
    )
    return out.withColumn(
        "all_checks_passed",
        F.col("shape_match") & F.col("schema_match") & (F.col("null_count") == 0)
        & (F.col("duplicate_count") == 0) & (F.col("type_mismatches") == 0),
    )


def _pairs(reference: DataFrame, cleaned: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
    cols = sorted(c for c in reference.columns if c != key and c in cleaned.columns)
    right = cleaned.select(qcol(key), *[qcol(c).alias(f"{c}_clean") for c in cols])
    return reference.select(qcol(key), *qcols(cols)).join(right, key, "inner"), cols


def _same(c: str, kind: str, tolerance: float) -> Column:
    a, b = qcol(c), qcol(f"{c}_clean")
    if kind in ("double", "float"):
        both_null = a.isNull() & b.isNull()
        return F.coalesce(F.abs(a - b) < tolerance, both_null)
    # Other types count as equal only when both values are present.
    return F.coalesce(a == b, F.lit(False))


def cell_match(reference: DataFrame, cleaned: DataFrame, key: str, tolerance: float = 0.01) -> DataFrame:
    """Per column: share of cells that agree on rows with a common key, and row coverage."""
    joined, cols = _pairs(reference, cleaned, key)
    types = dict(reference.dtypes)
    counts = joined.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(_same(c, types[c], tolerance)).alias(f"m{i}") for i, c in enumerate(cols)],
    ).withColumn("_ref", reference.agg(F.count(F.lit(1))).scalar())
    return rows_of(
        counts,
        [
            [
                ("column", F.lit(c)),
                ("matches", F.col(f"m{i}")),
                ("total", F.col("total")),
                ("match_pct", F.when(F.col("total") > 0, F.col(f"m{i}") / F.col("total") * 100).otherwise(0.0)),
                ("coverage_pct", F.try_divide(F.col("total"), F.col("_ref")) * 100),
            ]
            for i, c in enumerate(cols)
        ],
    )


def statistic_differences(reference: DataFrame, cleaned: DataFrame, cols: list[str]) -> DataFrame:
    """Relative difference of mean, median and standard deviation per column."""
    def stats(df: DataFrame) -> DataFrame:
        med = scalar_row(quantile_row(df, cols, [0.5]))
        one = df.agg(
            *[F.avg(qcol(c)).alias(f"{c}|mean") for c in cols],
            *[F.stddev_samp(qcol(c)).alias(f"{c}|std") for c in cols],
        ).withColumn("_m", med)
        return rows_of(
            one,
            [
                [("column", F.lit(c)), ("statistic", F.lit(s)), ("value", v)]
                for c in cols
                for s, v in (
                    ("mean", qcol(f"{c}|mean")),
                    ("median", F.col("_m").getField(f"{c}_q0")),
                    ("std", qcol(f"{c}|std")),
                )
            ],
        )

    ref = stats(reference).withColumnRenamed("value", "reference_value")
    # Three rows per column on each side.
    new = stats(cleaned).withColumnRenamed("value", "cleaned_value")
    joined = ref.join(F.broadcast(new), ["column", "statistic"])
    change = F.abs((F.col("cleaned_value") - F.col("reference_value")) / F.col("reference_value") * 100)
    return joined.withColumn("diff_pct", F.when(F.col("reference_value") != 0, change))


def worst_cells(reference: DataFrame, cleaned: DataFrame, key: str, columns: int = 3, rows: int = 3,
                tolerance: float = 0.01) -> DataFrame:
    """The first mismatching rows of the columns with most mismatches."""
    joined, cols = _pairs(reference, cleaned, key)
    types = dict(reference.dtypes)
    cells = joined.select(
        qcol(key),
        F.inline(
            F.array(
                *[
                    F.when(
                        ~_same(c, types[c], tolerance),
                        F.struct(
                            F.lit(c).alias("column"),
                            qcol(c).cast("string").alias("reference_value"),
                            qcol(f"{c}_clean").cast("string").alias("cleaned_value"),
                        ),
                    )
                    for c in cols
                ]
            )
        ),
    ).filter(F.col("column").isNotNull())
    worst = (
        cells.groupBy("column").agg(F.count(F.lit(1)).alias("mismatches"))
        .orderBy(F.desc("mismatches"), "column").limit(columns)
    )
    # At most ``columns`` rows on the right; the rank limit runs before the shuffle.
    few = cells.join(F.broadcast(worst), "column")
    at = F.row_number().over(W.partitionBy("column").orderBy(qcol(key)))
    return few.withColumn("row", at).filter(F.col("row") <= rows)


def schema_check(reference: DataFrame, production: DataFrame) -> DataFrame:
    """Missing columns and non-numeric type changes are errors, extra columns a warning."""
    ref, prod = dict(reference.dtypes), dict(production.dtypes)
    ref_num, prod_num = set(numeric_columns(reference)), set(numeric_columns(production))
    common = [c for c in ref if c in prod]
    failing = production.agg(
        F.count(F.lit(1)).alias("_total"),
        *[
            F.count_if(qcol(c).isNotNull() & qcol(c).try_cast(ref[c]).isNull()).alias(f"f{i}")
            for i, c in enumerate(common)
        ],
    )
    rows = []
    for c in sorted(set(ref) | set(prod)):
        if c not in prod:
            level, issue = "error", "missing in production"
        elif c not in ref:
            level, issue = "warning", "extra in production"
        elif ref[c] == prod[c] or (c in ref_num and c in prod_num):
            level, issue = "ok", "compatible"
        else:
            level, issue = "error", "type mismatch"
        rows.append(
            [
                ("column", F.lit(c)),
                ("level", F.lit(level)),
                ("issue", F.lit(issue)),
                ("reference_type", F.lit(ref.get(c)).cast("string")),
                ("production_type", F.lit(prod.get(c)).cast("string")),
                ("cast_failures", F.col(f"f{common.index(c)}") if c in common else F.lit(0).cast("bigint")),
            ]
        )
    return rows_of(failing, rows)


CYCLICAL = ["cyclical_hour_sin", "cyclical_hour_cos", "cyclical_day_sin", "cyclical_day_cos"]
TEMPORAL_FEATURES = ["hour", "day_of_week", "is_weekend", *CYCLICAL]


def temporal_report(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """One row: presence, ranges, type and unit-circle checks of the temporal features."""
    needed = TEMPORAL_FEATURES if required is None else required
    missing = sorted(c for c in needed if c not in df.columns)
    if missing:
        rows = df.agg(F.count(F.lit(1)).alias("rows"))
        return rows.select(
            F.lit(False).alias("valid"), F.lit(", ".join(missing)).alias("missing_features"), F.col("rows")
        )
    norm = lambda a: F.avg(qcol(f"cyclical_{a}_sin") ** 2 + qcol(f"cyclical_{a}_cos") ** 2)
    one = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("hour").alias("hour_min"), F.max("hour").alias("hour_max"),
        F.min("day_of_week").alias("day_min"), F.max("day_of_week").alias("day_max"),
        *[F.max(F.abs(qcol(c))).alias(f"{c}_max") for c in CYCLICAL],
        norm("hour").alias("hour_norm"), norm("day").alias("day_norm"),
        F.count_if(qcol("hour").isNull() | qcol("day_of_week").isNull()).alias("null_rows"),
    )
    boolean = dict(df.dtypes)["is_weekend"] == "boolean"
    circle = F.lit(True)
    for c in CYCLICAL:
        circle = circle & (F.col(f"{c}_max") <= 1.01)
    out = one.select(
        "rows", "null_rows", "hour_min", "hour_max", "day_min", "day_max", "hour_norm", "day_norm",
        ((F.col("hour_min") >= 0) & (F.col("hour_max") <= 23)).alias("hour_ok"),
        ((F.col("day_min") >= 0) & (F.col("day_max") <= 6)).alias("day_ok"),
        F.lit(boolean).alias("weekend_is_boolean"),
        circle.alias("cyclical_ok"),
        ((F.abs(F.col("hour_norm") - 1) <= 0.01) & (F.abs(F.col("day_norm") - 1) <= 0.01)).alias("norm_ok"),
        F.lit("").alias("missing_features"),
    )
    return out.withColumn(
        "valid",
        F.col("hour_ok") & F.col("day_ok") & F.col("weekend_is_boolean") & F.col("cyclical_ok") & F.col("norm_ok"),
    )


def split_report(df: DataFrame, split: str, target: str, expected: dict[str, float], tolerance: float = 0.02,
                 key_cols: list[str] | None = None) -> DataFrame:
    """One row: split shares, keys found in more than one split, and target mean drift.

    ``expected`` maps split names to shares, the training split first. Keys default
    to the first five columns.
    """
    keys = key_cols or [c for c in df.columns if c != split][:5]
    names = list(expected)
    is_in = lambda s: qcol(split) == s
    one = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(is_in(s)).alias(f"{s}_count") for s in names],
        *[F.avg(F.when(is_in(s), qcol(target))).alias(f"{s}_mean") for s in names],
        *[F.stddev_samp(F.when(is_in(s), qcol(target))).alias(f"{s}_std") for s in names],
    )
    groups = df.groupBy(*qcols(keys)).agg(*[F.max(is_in(s)).alias(f"_in_{s}") for s in names])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    leaks = scalar_row(
        groups.agg(*[F.count_if(F.col(f"_in_{a}") & F.col(f"_in_{b}")).alias(f"{a}_{b}_overlap") for a, b in pairs])
    )
    out = one.withColumn("_leaks", leaks)
    train = names[0]
    sizes_ok, leak_free, similar = F.lit(True), F.lit(True), F.lit(True)
    for s in names:
        sizes_ok = sizes_ok & (F.abs(F.try_divide(F.col(f"{s}_count"), F.col("total")) - F.lit(expected[s])) <= tolerance)
    for a, b in pairs:
        leak_free = leak_free & (F.col("_leaks").getField(f"{a}_{b}_overlap") == 0)
    for s in names[1:]:
        similar = similar & (F.try_divide(F.abs(F.col(f"{train}_mean") - F.col(f"{s}_mean")), F.col(f"{train}_mean")) < 0.10)
    return out.select(
        "total",
        *[f"{s}_count" for s in names],
        *[f"{s}_mean" for s in names],
        *[f"{s}_std" for s in names],
        *[F.col("_leaks").getField(f"{a}_{b}_overlap").alias(f"{a}_{b}_overlap") for a, b in pairs],
        sizes_ok.alias("sizes_ok"), leak_free.alias("no_leakage"), similar.alias("similar_target"),
        (sizes_ok & leak_free & similar).alias("valid"),
    )


def data_gate(df: DataFrame, split: str, target: str, expected: dict[str, float],
              key_cols: list[str] | None = None) -> DataFrame:
    """Split checks plus the number of nulls over all splits; ``passed`` needs none."""
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + qcol(c).isNull().cast("int")
    total = df.agg(F.coalesce(F.sum(nulls), F.lit(0))).scalar()
    report = split_report(df, split, target, expected, key_cols=key_cols).withColumn("total_nulls", total)
    return report.withColumn("passed", F.col("valid") & (F.col("total_nulls") == 0))


