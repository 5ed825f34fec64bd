"""Encoding of categories of any number as a pipeline stage: the categories are a table, not columns or parameters."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable,
    MLWriter)
from pyspark.sql import DataFrame, functions as F

from wattspan.functions.columns import qcol, qcols, require
from wattspan.operators.prep import _HasColumns, category_table, index_categories
from wattspan.operators.small import checkpointed

INDEX, VECTOR = "_index", "_vector"
TABLE_SCHEMA = "column string, category string, index bigint"


class _TableWriter(MLWriter):
    """The parameters as metadata, the categories as Parquet beside them."""

    def __init__(self, model: TableEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.parquet(f"{path}/categories")


class _TableReader(MLReader):
    def load(self, path: str) -> TableEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TableEncoderModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.table = self.sparkSession.read.schema(TABLE_SCHEMA).parquet(f"{path}/categories")
        return model


class TableEncoderModel(Model, _HasColumns, MLWritable, MLReadable):
    """Replaces each column by ``<c>_index`` and ``<c>_vector``.

    The index is the category's place in sorted order, from 0; unknown and null values have none. The vector is sparse,
    with one entry per category but the first; the first, unknown and null values give zeros. It has a size of 1 at least.
    """

    sizes = Param(Params._dummy(), "sizes", "number of categories per column, JSON", typeConverter=TypeConverters.toString)

    def __init__(self, columns=None, sizes=None, table: DataFrame | None = None):
        super().__init__()
        self._setDefault(columns=[], exclude=[], sizes="{}")
        self.table = table
        if columns is not None:
            self._set(columns=columns, sizes=json.dumps(sizes))

    def known(self) -> dict[str, int]:
        return json.loads(self.getOrDefault("sizes"))

    def copy(self, extra=None):
        that = super().copy(extra)
        that.table = self.table
        return that

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader()

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, known = self.used(), self.known()
        if not cols:
            return df
        require(df, cols)
        width = {c: max(known[c] - 1, 1) for c in cols}
        out = index_categories(df, self.table, cols, INDEX)
        # Places beyond the width are zeros to the encoder.
        place = lambda c: F.when(qcol(c + INDEX) > 0, qcol(c + INDEX) - 1).otherwise(F.lit(width[c])).cast("double")
        out = out.withColumns({f"_place{i}": place(c) for i, c in enumerate(cols)})
        names = [f"_place{i}" for i in range(len(cols))]
        # The encoder learns its sizes from one row with the last place of every column.
        last = df.sparkSession.range(1).select(*[F.lit(float(width[c] - 1)).alias(n) for n, c in zip(names, cols)])
        encoder = OneHotEncoder(inputCols=names, outputCols=[c + VECTOR for c in cols], handleInvalid="keep", dropLast=True)
        out = encoder.fit(last).transform(out)
        return out.select(*qcols(c for c in out.columns if c not in cols and c not in names))


class TableEncoder(Estimator, _HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Finds the sorted categories of each column, without a limit; columns are read as text.

    One number per column reaches the driver. The table is checkpointed, and saved with the model.
    """

    @keyword_only
    def __init__(self, columns=None, exclude=None):
        super().__init__()
        self._setDefault(columns=[], exclude=[])
        self._set(columns=columns or [], exclude=exclude or [])

    def _fit(self, df: DataFrame) -> TableEncoderModel:
        cols = self.used()
        require(df, cols)
        if not cols:
            return TableEncoderModel([], {}, df.sparkSession.createDataFrame([], TABLE_SCHEMA))
        table = checkpointed(category_table(df, cols).select("column", "category", F.col("index").cast("bigint").alias("index")))
        counted = {row["column"]: row["n"] for row in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        return TableEncoderModel(cols, {c: counted.get(c, 0) for c in cols}, table)
