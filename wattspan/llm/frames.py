"""Small helpers shared by the operators: narrow selections, slices in tasks, scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import qcol, require
from wattspan.llm.batches import release, slices
from wattspan.operators.small import checkpoint_dir


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id as bigint and the text, named ``_id`` and ``_text``, so that no other column can clash."""
    require(docs, [id_col, text_col])
    return docs.select(qcol(id_col).cast("bigint").alias("_id"), qcol(text_col).cast("string").alias("_text"))


def by_slice(df: DataFrame, fn: Callable, schema: str, text_col: str = "_text", keep: bool = False) -> DataFrame:
    """Runs ``fn(batch, lo, hi, data, off)`` on slices of bounded bytes; it gives the output columns of the slice.

    Without ``keep`` a task first frees what other tasks left in its worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            release()
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(text_col)):
                yield pa.RecordBatch.from_pydict(fn(batch, lo, hi, data, off))

    return df.mapInArrow(run, schema)


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Writes a table below the shared checkpoint folder and reads it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/wattspan-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int, limit_bytes: int = 64 << 20) -> DataFrame:
    """Marks a side for broadcast when its counted rows times the width of one row stay below the limit."""
    return F.broadcast(df) if rows * row_bytes <= limit_bytes else df
