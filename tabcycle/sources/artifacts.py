"""JSON artifacts: the chosen cut-off and the feature types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabcycle.functions.columns import named
from tabcycle.schemas import FEATURE_TYPES, THRESHOLD_ARTIFACT


def write_threshold(selection: DataFrame, location: str) -> None:
    """Write the row that `select_cutoff` gives; every value as text, as readers expect it."""
    texts = [named(f.name).cast("string").alias(f.name) for f in THRESHOLD_ARTIFACT.fields]
    selection.select(*texts).write.mode("overwrite").json(location)


def read_threshold(spark: SparkSession, location: str) -> DataFrame:
    """The chosen cut-off, numbers as doubles. Takes a file as well as a folder."""
    raw = spark.read.schema(THRESHOLD_ARTIFACT).json(location, multiLine=True)
    numbers = {c: named(c).cast("double") for c in ("precision", "recall", "cut-off")}
    return raw.withColumns(numbers)


def write_feature_types(spark: SparkSession, categories: Sequence[str], numbers: Sequence[str], location: str) -> None:
    row = spark.createDataFrame([(list(categories), list(numbers))], FEATURE_TYPES)
    row.write.mode("overwrite").json(location)


def read_feature_types(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.schema(FEATURE_TYPES).json(location, multiLine=True)


def feature_type_rows(types: DataFrame) -> DataFrame:
    """Rows (feature, kind) of a feature-type artifact."""
    return types.select(
        F.inline(
            F.concat(
                F.transform("category_col", lambda c: F.struct(c.alias("feature"), F.lit("category").alias("kind"))),
                F.transform("Cont_cols", lambda c: F.struct(c.alias("feature"), F.lit("number").alias("kind"))),
            )
        )
    )
