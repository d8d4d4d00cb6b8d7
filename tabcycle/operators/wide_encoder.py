"""One-hot encoding of columns with very many values: numbered slots in a table, sparse vectors as output.

`OneHotColumns` makes a column per value, whose names the driver holds. Here a value is a row of a slot table, numbered
by its place among the sorted values, and encoding is a join with that table. Neither the values nor their names pass the driver.
"""

from __future__ import annotations

import uuid

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabcycle.functions.columns import named
from tabcycle.operators.encoders import category_values
from tabcycle.sources.shared import reliable, shared_folder

SLOTS = "feature string, value string, slot bigint"


def numbered_values(values: DataFrame) -> DataFrame:
    """Rows (feature, value, slot): the place of each value, from 0, among the sorted ones of its feature.

    `values` has distinct rows (feature, value). They are dealt by ranges and sorted there, so no task sees them all; a
    value's place is its row number in the range and the number of its feature's values in the ranges before. The
    sorted rows are written to the shared folder, because their numbers hang on the ranges.
    """
    ordered = values.repartitionByRange("feature", "value").sortWithinPartitions("feature", "value")
    ordered = reliable(
        ordered.select("feature", "value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("nth"))
    )
    # One row per range and feature that meet.
    parts = ordered.groupBy("feature", "part").agg(F.min("nth").alias("first"), F.count("*").alias("n"))
    along = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0))).drop("n")
    return ordered.join(parts, ["feature", "part"]).select(
        "feature", "value", (F.col("nth") - F.col("first") + F.col("before")).alias("slot")
    )


class _WideParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to encode", TypeConverters.toListString)
    excludeCategories = Param(Params._dummy(), "excludeCategories", "column -> values without a slot")
    dropOriginal = Param(Params._dummy(), "dropOriginal", "drop the input columns", TypeConverters.toBoolean)


class WideOneHot(Estimator, _WideParams, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers the values of each column, as text and without NULL.

    The fitted model adds `<column>_slot`, the value's number, and `<column>_vector`, a sparse vector with a 1 at this number.
    A value without a slot and NULL get NULL and the empty vector.
    """

    @keyword_only
    def __init__(
        self, *, inputCols: list[str] | None = None, excludeCategories: dict | None = None, dropOriginal: bool = False
    ):
        super().__init__()
        self._setDefault(excludeCategories={}, dropOriginal=False)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> WideOneHotModel:
        columns = self.getOrDefault("inputCols")
        location = f"{shared_folder(df.sparkSession)}/slots-{uuid.uuid4().hex}"
        values = category_values(df, columns, self.getOrDefault("excludeCategories"))
        numbered_values(values).write.partitionBy("feature").parquet(location)
        counted = _slots(df.sparkSession, location).groupBy("feature").agg(F.count("*").alias("n"))
        sizes = {r.feature: r.n for r in counted.collect()}  # one row per column
        model = WideOneHotModel(
            slotTable=location, sizes=[[c, sizes.get(c, 0)] for c in columns], dropOriginal=self.getOrDefault("dropOriginal")
        )
        return model._resetUid(self.uid)


def _slots(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.schema(SLOTS).parquet(location)


class WideOneHotModel(Model, MLWritable, MLReadable):
    """The slot table's place and how many slots each column has. Saving copies the table into the model's folder."""

    slotTable = Param(Params._dummy(), "slotTable", "folder of the slot table", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "[column, number of slots] pairs")
    dropOriginal = Param(Params._dummy(), "dropOriginal", "drop the input columns", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, slotTable: str | None = None, sizes: list | None = None, dropOriginal: bool = False):
        super().__init__()
        self._setDefault(dropOriginal=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def slots(self, spark: SparkSession) -> DataFrame:
        """Rows (feature, value, slot)."""
        return _slots(spark, self.getOrDefault("slotTable")).select("feature", "value", "slot")

    def _transform(self, df: DataFrame) -> DataFrame:
        slots = self.slots(df.sparkSession)
        for column, size in self.getOrDefault("sizes"):
            own = slots.filter(F.col("feature") == column).select(F.col("value").alias("__value"), F.col("slot").alias(f"{column}_slot"))
            df = df.join(own, named(column).cast("string") == F.col("__value"), "left").drop("__value")
            # One slot more than there are values stands for none of them; the encoder leaves the last one out.
            told = {"ml_attr": {"type": "nominal", "num_vals": size + 1}}
            at = F.coalesce(named(f"{column}_slot"), F.lit(size)).cast("double")
            df = df.select("*", at.alias("__at", metadata=told))
            encoder = OneHotEncoder(inputCols=["__at"], outputCols=[f"{column}_vector"], dropLast=True).fit(df)
            df = encoder.transform(df).drop("__at")
        return df.drop(*[c for c, _ in self.getOrDefault("sizes")]) if self.getOrDefault("dropOriginal") else df

    def write(self) -> MLWriter:
        return _WideWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _WideReader(cls)


class _WideWriter(MLWriter):
    def __init__(self, stage: WideOneHotModel):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.slots(self.sparkSession).write.partitionBy("feature").parquet(f"{path}/slots")


class _WideReader(MLReader):
    def __init__(self, cls: type[WideOneHotModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> WideOneHotModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage._set(slotTable=f"{path}/slots")
