"""Schema questions and plain projections: types, shape, input features, casts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def named(column: str) -> Column:
    """The column called `column`, whatever characters its name holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def double_array(values: Sequence[float]) -> Column:
    """An array literal; one parsed expression instead of a call to the JVM per entry."""
    return F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in df.schema.fields}


def columns_of_type(df: DataFrame, wanted: str | T.DataType | type[T.DataType] = "string") -> list[str]:
    """Names of the columns of one type, in table order.

    The type may be an instance, a class, or any of its names
    (`string`, `StringType`, `decimal(10,2)`).
    """
    if isinstance(wanted, T.DataType):
        return [f.name for f in df.schema.fields if f.dataType == wanted]
    if isinstance(wanted, type):
        return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]
    name = wanted.removesuffix("()")
    return [
        f.name
        for f in df.schema.fields
        if name in (f.dataType.typeName(), f.dataType.simpleString(), type(f.dataType).__name__)
    ]


def shape_frame(df: DataFrame) -> DataFrame:
    """One row (rows, columns) as a lazy frame; the count needs no column from the scan."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def input_features(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    excluded = set(exclude)
    return [c for c in df.columns if c not in excluded]


def change_types(df: DataFrame, types: Mapping[str, str | T.DataType], safe: bool = False) -> DataFrame:
    """Cast columns in place, all in one projection.

    With `safe` a value that does not fit becomes NULL instead of failing the job.
    """
    if safe:
        return df.withColumns({c: named(c).try_cast(t) for c, t in types.items()})
    return df.withColumns({c: named(c).cast(t) for c, t in types.items()})


def long_form(df: DataFrame, keep: Sequence[str], columns: Sequence[str], feature: str, value: str) -> DataFrame:
    """One row per row and column: the kept columns, the column's name and its value (all of one type).

    `stack` rather than `unpivot`: the plan reads such frames more than once, and
    Spark does not see that two unpivots with kept columns are the same.
    """
    pairs = [part for c in columns for part in (F.lit(c), named(c))]
    long = df.select(*map(named, keep), F.stack(F.lit(len(columns)), *pairs).alias(feature, value))
    # Always true. Joins on the name would add it on their side only, and reads would differ.
    return long.filter(F.col(feature).isNotNull())


def capture_date_column(capture_date: dt.date | str | None) -> Column:
    """The date stamped on a log row: the caller's, or today's when none is given."""
    if capture_date is None:
        return F.current_date()
    return F.lit(str(capture_date)).cast("date")


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
