"""Session settings that depend on the size of the input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20) -> int:
    """Sets the shuffle partitions so that one holds about ``partition_bytes``; never fewer than before.

    Order-based operators cut their series into as many slices.
    """
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(now, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def apply_settings(spark: SparkSession) -> None:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


class Tables:
    """Named tables by query, limit, schema and existence."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def query(self, sql: str, **args) -> DataFrame:
        return self.spark.sql(sql, args or None)

    def reference(self, name: str, limit: int | None = None) -> DataFrame:
        df = self.spark.table(name)
        return df if limit is None else df.limit(limit)

    def schema(self, name: str) -> list[tuple[str, str]]:
        return self.spark.table(name).dtypes

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)
