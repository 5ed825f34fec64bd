"""A corpus pipeline of numbered operators: ``run`` applies the stages to ``documents`` in order.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read back as the next one's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattspan.functions.columns import set_columns
from wattspan.llm import decontaminate, line_dedup, near_dups, packing, quality_rules
from wattspan.llm.frames import scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or score below the limit go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = set_columns(out, {"n_chars": F.when(F.col("n_dropped") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))})
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest id stays."""
    gone = near_dups.near_duplicates(docs).filter("NOT kept AND doc_id IS NOT NULL").select("doc_id")
    return docs.join(gone.distinct(), ["doc_id"], "left_anti")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the training sequences."""
    return packing.pack(docs).drop("ids")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("packing", sequences),
]

# The first stage's hashed scores and the last one's token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
