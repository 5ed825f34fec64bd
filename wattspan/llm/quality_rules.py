"""Quality rules: hashed n-gram log-likelihood ratio between trusted documents and the whole corpus.

Tokens are runs of letters and digits, or of other visible characters. Single
tokens and pairs are hashed to ``BUCKETS`` buckets. Two multinomials are counted:
one over all documents, one over trusted ones (labelled good; at most
``MOST_TRUSTED`` of them, those with the smallest hash of their id). The trusted
one is smoothed towards the corpus, so rare buckets say little. A document's
score is the mean of the log ratio over its n-grams. A document is kept when it
passes the base rules and its score is at least ``LEAST_SCORE``; every document
is judged, and equal texts get equal verdicts.

Only the bucket table, whose size is fixed, leaves the executors. Nothing but
built-in functions runs on the texts.

A null or empty text has no words and fails the base rules. Without trusted
documents all scores are 0. Repeated rows are counted and judged each. Other
columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import qcol, require
from wattspan.llm.frames import texts

BUCKETS = 1 << 14
SMOOTHING = float(BUCKETS)
MOST_TRUSTED = 100_000
LEAST_SCORE = -0.25
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# White space that separates words, and the symbols counted.
WORD_SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def described(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``_doc`` (the whole row), ``_text`` (null as empty) and the base counts."""
    slim = docs.select(F.struct("*").alias("_doc"), F.coalesce(qcol(text_col).cast("string"), F.lit("")).alias("_text"))
    split = slim.select("_doc", "_text", words_of(F.col("_text")).alias("_w"))
    n = F.size("_w")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    hashed = split.select("_doc", "_text", n.alias("_n"), windows.alias("_h"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.translate(x, WORD_SPACE, "") != "")
    counted = hashed.select(
        "_doc", "_text", F.col("_n").cast("bigint").alias("n_words"),
        F.length(_without(F.col("_text"), WORD_SPACE)).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_h")) < F.size("_h"),
               F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"),
    )
    # Starts of windows whose hash a neighbour in hash order shares.
    shared = counted.withColumn("_p", F.sort_array(F.filter(F.transform("_s", lambda x, k: F.when(
        F.get("_s", k - 1)["h"].eqNullSafe(x["h"]) | F.get("_s", k + 1)["h"].eqNullSafe(x["h"]), x["i"])),
        lambda i: i.isNotNull())))
    covered = F.aggregate(
        "_p", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return shared.select(
        "_doc", "_text", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words"))


def with_buckets(df: DataFrame, text: str = "_text") -> DataFrame:
    """Replaces the text by ``_b``, the buckets of all tokens and of all pairs of neighbours.

    The tokens are a column of their own: a lambda would split the text again for each element.
    """
    split = df.withColumn("_t", F.regexp_extract_all(text, F.lit(TOKEN), 0)).drop(text)
    single = F.transform("_t", lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int"))
    pair = F.transform("_t", lambda t, i: F.pmod(F.xxhash64(t, F.get("_t", i + 1)), F.lit(BUCKETS)).cast("int"))
    pairs = F.slice(pair, F.lit(1), F.greatest(F.size("_t") - 1, F.lit(0)))
    return split.withColumn("_b", F.concat(single, pairs)).drop("_t")


def trusted_ids(labels: DataFrame, label_id: str = "doc_id", label_col: str = "quality",
                most: int = MOST_TRUSTED) -> DataFrame:
    """At most ``most`` ids with label 1, by the smallest hash; few enough to broadcast."""
    ids = labels.filter(qcol(label_col) == 1).select(qcol(label_id).cast("bigint").alias("_trusted")).distinct()
    return ids.filter("_trusted IS NOT NULL").orderBy(F.xxhash64("_trusted"), "_trusted").limit(most)


def log_ratios(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """Log of the trusted over the corpus share of each bucket; ``BUCKETS`` numbers."""
    slim = texts(docs, id_col, text_col)
    # At most MOST_TRUSTED rows of 8 bytes.
    flagged = slim.join(F.broadcast(trusted_ids(labels)), F.col("_id") == F.col("_trusted"), "left")
    named = flagged.select(F.coalesce("_text", F.lit("")).alias("_text"), F.col("_trusted").isNotNull().cast("int").alias("t"))
    # An inner explode would make the optimizer filter on the size of the array, built anew with the split inside.
    rows = with_buckets(named).select("t", F.explode_outer("_b").alias("b")).filter("b IS NOT NULL")
    counts = rows.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"))
    all_ = counts.agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    share = F.col("n") / F.col("all_n")
    ratio = F.log((F.col("t") + SMOOTHING * share) / (F.col("all_t") + SMOOTHING) / share)
    totals = all_.select(F.struct("*")).scalar()
    table = counts.withColumns({"all_n": totals["n"], "all_t": totals["t"]}).select("b", ratio.alias("r"))
    out = [0.0] * BUCKETS
    for row in table.toLocalIterator():
        out[row.b] = row.r
    return out


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           least_score: float = LEAST_SCORE) -> DataFrame:
    """``_doc``, the base counts, ``base_failed``, ``score`` and ``kept``."""
    ratios = log_ratios(docs, labels, id_col, text_col)
    # One constant array; the optimizer folds it.
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    buckets = with_buckets(described(docs, text_col))
    total = F.aggregate("_b", F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    score = F.when(F.size("_b") > 0, total / F.size("_b")).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    scored = buckets.withColumns({"score": score, "base_failed": failed}).drop("_b")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least_score))


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least_score: float = LEAST_SCORE) -> DataFrame:
    """Per row: the id, the base counts, ``base_failed``, ``score`` and ``kept``."""
    require(docs, [id_col, text_col])
    out = judged(docs, labels, id_col, text_col, least_score)
    return out.select(F.col("_doc")[id_col].alias(id_col), *out.drop("_doc").columns)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows that are kept, with their own columns; they are judged where they are, without a join."""
    # The optimizer does not move a filter below a column that is not deterministic. Moved down, this one would hold the
    # whole score, which splits the text anew for each token.
    out = judged(docs, labels, id_col, text_col, least_score).withColumn("_part", F.spark_partition_id())
    return out.filter("kept AND _part >= 0").select("_doc.*")
