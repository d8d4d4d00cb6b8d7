"""Feature-engineering stages: named indicators, ordinal maps, regex numbers, casts, drops.

What a stage learns it learns in `fit`; `transform` is one projection, with no
action and no Python worker, so a fitted pipeline is safe to serve and to stream.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F, types as T

from tabcycle.functions.columns import change_types, long_form, named
from tabcycle.functions.text import (
    indicator_name,
    regex_all,
    regex_first,
    translate_values,
)


class _Stored(DefaultParamsReadable, DefaultParamsWritable):
    """Stages whose parameters hold everything they need."""


def category_values(df: DataFrame, columns: Sequence[str], exclude: Mapping | None = None) -> DataFrame:
    """Distinct non-NULL values of each column as text: rows (feature, value).

    One scan and one shuffle for all columns. Values are made distinct on the
    map side first, so a frequent value costs one row per task.
    """
    texts = df.select(*[named(c).cast("string").alias(c) for c in columns])
    values = long_form(texts, [], columns, "feature", "value")
    values = values.filter(F.col("value").isNotNull()).distinct()
    for column, dropped in (exclude or {}).items():
        if column in columns and dropped:
            values = values.filter(
                ~((F.col("feature") == column) & F.col("value").isin([str(v) for v in dropped]))
            )
    return values


class _OneHotParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to encode", TypeConverters.toListString)
    excludeCategories = Param(Params._dummy(), "excludeCategories", "column -> values without an indicator")
    dropCols = Param(Params._dummy(), "dropCols", "columns to drop afterwards", TypeConverters.toListString)
    dropOriginal = Param(Params._dummy(), "dropOriginal", "drop dropCols", TypeConverters.toBoolean)
    dropLast = Param(
        Params._dummy(), "dropLast", "leave out the last indicator of several", TypeConverters.toBoolean
    )
    maxCategories = Param(
        Params._dummy(), "maxCategories", "most values one column may have, 0 for any number", TypeConverters.toInt
    )


class OneHotColumns(Estimator, _OneHotParams, _Stored):
    """Learns the values of each column and gives one named 0/1 column per value.

    Values sort by code point. `dropLast` leaves out the last one when there are
    several. `dropCols` defaults to the input columns.
    """

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        excludeCategories: dict | None = None,
        dropCols: list[str] | None = None,
        dropOriginal: bool = True,
        dropLast: bool = True,
        maxCategories: int = 0,
    ):
        super().__init__()
        self._setDefault(excludeCategories={}, dropOriginal=True, dropLast=True, maxCategories=0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "OneHotColumnsModel":
        columns = self.getOrDefault("inputCols")
        learned = self._learn(df, columns)
        if self.getOrDefault("dropLast"):
            learned = {c: vs[:-1] if len(vs) > 1 else vs for c, vs in learned.items()}
        dropped = []
        if self.getOrDefault("dropOriginal"):
            dropped = self.getOrDefault("dropCols") if self.isSet("dropCols") else columns
        model = OneHotColumnsModel(categories=[[c, learned[c]] for c in columns], dropCols=dropped)
        _refuse_name_clashes(df, model.output_names(), dropped)
        return model._resetUid(self.uid)

    def _learn(self, df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
        # The values become columns, whose names the driver holds anyway.
        most = self.getOrDefault("maxCategories")
        exclude = self.getOrDefault("excludeCategories")
        if not columns:
            return {}
        found = category_values(df, columns, exclude)
        found = (found.limit(most * len(columns) + 1) if most else found).collect()
        learned: dict[str, list[str]] = {c: [] for c in columns}
        for row in found:
            learned[row["feature"]].append(row["value"])
        for column, values in learned.items():
            if most and len(values) > most:
                raise ValueError(
                    f"column {column!r} has more than maxCategories={most} values; "
                    "it is not a category, or the limit must be raised"
                )
        return {c: sorted(values) for c, values in learned.items()}


class OneHotColumnsModel(Model, _Stored):
    categories = Param(Params._dummy(), "categories", "[column, values] pairs, in output order")
    dropCols = Param(Params._dummy(), "dropCols", "columns to drop afterwards", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, categories: list | None = None, dropCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def output_names(self) -> list[str]:
        return [indicator_name(c, v) for c, values in self.getOrDefault("categories") for v in values]

    def _transform(self, df: DataFrame) -> DataFrame:
        indicators = []
        for column, values in self.getOrDefault("categories"):
            text = named(column)
            if not isinstance(df.schema[column].dataType, T.StringType):
                text = text.cast("string")
            indicators += [
                F.when(text == F.lit(v), 1).otherwise(0).alias(indicator_name(column, v)) for v in values
            ]
        return df.select("*", *indicators).drop(*self.getOrDefault("dropCols"))


def _refuse_name_clashes(df: DataFrame, names: list[str], dropped: list[str]) -> None:
    """Two indicators of one name, or one named like a column that stays, cannot be told apart."""
    fold = str if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    staying = [c for c in df.columns if c not in dropped]
    clashes = [n for n, times in Counter(map(fold, names + staying)).items() if times > 1]
    clashes = [n for n in names if fold(n) in clashes]
    if clashes:
        raise ValueError(f"indicator names are not unique: {sorted(set(clashes))}")


class OrdinalMap(Transformer, _Stored):
    """Adds `<column>_transformed`: the number a category stands for, as a float.

    NULL and unmapped values become `naValue` unless `replaceNa` is off, and NULL then.
    """

    mappings = Param(Params._dummy(), "mappings", "[column, [[category, number], ...]] pairs")
    dropOriginal = Param(Params._dummy(), "dropOriginal", "drop the mapped columns", TypeConverters.toBoolean)
    replaceNa = Param(Params._dummy(), "replaceNa", "fill unmapped values", TypeConverters.toBoolean)
    naValue = Param(Params._dummy(), "naValue", "number for unmapped values", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self,
        *,
        mappings: dict | list | None = None,
        dropOriginal: bool = True,
        replaceNa: bool = True,
        naValue: float = 0.0,
    ):
        super().__init__()
        self._setDefault(dropOriginal=True, replaceNa=True, naValue=0.0)
        given = dict(self._input_kwargs)
        if isinstance(given.get("mappings"), Mapping):
            # Pairs, not objects: JSON would turn number keys into text.
            given["mappings"] = [[c, [[k, float(v)] for k, v in m.items()]] for c, m in mappings.items()]
        self._set(**given)

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = self.getOrDefault("mappings")
        for column, entries in pairs:
            df = translate_values(df, column, {k: v for k, v in entries}, column + "_transformed")
        outputs = {}
        for column, _ in pairs:
            value = named(column + "_transformed")
            if self.getOrDefault("replaceNa"):
                value = F.coalesce(value, F.lit(self.getOrDefault("naValue")))
            outputs[column + "_transformed"] = value.cast("float")
        df = df.withColumns(outputs)
        return df.drop(*[c for c, _ in pairs]) if self.getOrDefault("dropOriginal") else df


class RegexNumber(Transformer, _Stored):
    """Adds `<column>_transformed`: what a pattern finds in the column.

    The first hit as a float by default, as text without `asNumber`, and every
    hit as an array without `firstOnly`. No hit, NULL or no number give NULL.
    """

    inputCols = Param(Params._dummy(), "inputCols", "columns to search", TypeConverters.toListString)
    pattern = Param(Params._dummy(), "pattern", "regular expression", TypeConverters.toString)
    firstOnly = Param(Params._dummy(), "firstOnly", "first hit only", TypeConverters.toBoolean)
    asNumber = Param(Params._dummy(), "asNumber", "first hit as a float", TypeConverters.toBoolean)
    dropOriginal = Param(Params._dummy(), "dropOriginal", "drop the input columns", TypeConverters.toBoolean)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        pattern: str | None = None,
        firstOnly: bool = True,
        asNumber: bool = True,
        dropOriginal: bool = True,
    ):
        super().__init__()
        self._setDefault(firstOnly=True, asNumber=True, dropOriginal=True)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        columns, pattern = self.getOrDefault("inputCols"), self.getOrDefault("pattern")
        if self.getOrDefault("firstOnly"):
            as_number = self.getOrDefault("asNumber")
            found = {c + "_transformed": regex_first(named(c), pattern, as_number) for c in columns}
        else:
            found = {c + "_transformed": regex_all(named(c), pattern) for c in columns}
        df = df.withColumns(found)
        return df.drop(*columns) if self.getOrDefault("dropOriginal") else df


class CastColumns(Transformer, _Stored):
    """Casts columns in place."""

    types = Param(Params._dummy(), "types", "column -> type name")
    safe = Param(Params._dummy(), "safe", "NULL for values that do not fit", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, types: dict | None = None, safe: bool = False):
        super().__init__()
        self._setDefault(safe=False)
        given = dict(self._input_kwargs)
        if types is not None:
            given["types"] = {
                c: t.simpleString() if isinstance(t, T.DataType) else t for c, t in types.items()
            }
        self._set(**given)

    def _transform(self, df: DataFrame) -> DataFrame:
        return change_types(df, self.getOrDefault("types"), self.getOrDefault("safe"))


class DropColumns(Transformer, _Stored):
    """Drops columns; names the frame does not have are passed over."""

    cols = Param(Params._dummy(), "cols", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, cols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault("cols"))
