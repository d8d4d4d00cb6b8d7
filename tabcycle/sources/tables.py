"""Table input and the log sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(
    spark: SparkSession, location: str, fmt: str = "parquet", columns: Sequence[str] | None = None, **options
) -> DataFrame:
    """A table as a frame; `fmt="table"` reads a catalog table. Named columns narrow the scan."""
    df = spark.table(location) if fmt == "table" else spark.read.format(fmt).options(**options).load(location)
    return df.select(*columns) if columns else df


def append_log(log: DataFrame, location: str, run_id: str | None = None) -> None:
    """Add a metric, feature-score or drift log to its table, one folder per capture date and run.

    A run that is written again under its `run_id`, after a failure or by a retried job, replaces what it wrote for the
    same dates and touches no other run. Without an id the call is a run of its own. The rebalance keeps the few rows
    of a run in one file per date and splits a large log.
    """
    run = log.withColumn("run_id", F.lit(run_id or uuid.uuid4().hex))
    writer = run.hint("rebalance", "capture_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("capture_date", "run_id").parquet(location)


def read_log(spark: SparkSession, location: str, schema: StructType, run_id: str | None = None) -> DataFrame:
    """A log table, or one run of it; filters on `capture_date` and the run prune folders."""
    stored = StructType([*schema.fields, StructField("run_id", StringType())])
    log = spark.read.schema(stored).parquet(location)
    return (log.filter(F.col("run_id") == run_id) if run_id else log).select(*schema.names)
