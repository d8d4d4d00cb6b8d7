"""Drift between two frames: Jensen-Shannon and Kullback-Leibler divergence, Kolmogorov-Smirnov, report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabcycle.functions.columns import capture_date_column, named
from tabcycle.functions.tails import kolmogorov_tail
from tabcycle.plans.running import running_counts


def side_counts(left: DataFrame, right: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """Rows (is_number, feature, text, number, in_left, in_right): how often each value occurs on either side.

    Each side is read once for all features of both kinds, and counted in one shuffle. What is a number is told by an
    aggregate: a filter on it stays above the counting, so that everything that follows reuses this shuffle. A feature may
    be a category and a number at once.
    """
    categories, numbers = list(dict.fromkeys(categories)), list(dict.fromkeys(numbers))
    names = list(dict.fromkeys([*categories, *numbers]))
    # The union widens numbers of two types, so that 1 and 1.0 are one category.
    numeric = {f for f in names if all(isinstance(df.schema[f].dataType, T.NumericType) for df in (left, right))}
    sides = [
        df.select(
            F.lit(side).alias("__side"),
            *[(named(f) if f in numeric else named(f).cast("double" if f in numbers else "string")).alias(f) for f in names],
        )
        for side, df in enumerate((left, right))
    ]
    both = sides[0].unionByName(sides[1])
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    parts = [(F.lit(False), F.lit(f), named(f).cast("string"), no_number) for f in categories]
    parts += [(F.lit(True), F.lit(f), no_text, named(f).cast("double")) for f in numbers]
    stacked = F.stack(F.lit(len(parts)), *[c for part in parts for c in part])
    long = both.select("__side", stacked.alias("__number", "feature", "text", "number"))
    # Always true. Joins on the name would add it on their side only, and reads would differ.
    long = long.filter(F.col("feature").isNotNull())
    counts = long.groupBy("feature", "text", "number", "__number").agg(
        F.max("__number").alias("is_number"),
        F.count_if(F.col("__side") == 0).alias("in_left"),
        F.count_if(F.col("__side") == 1).alias("in_right"),
    )
    return counts.select("is_number", "feature", "text", "number", "in_left", "in_right")


def category_distribution(left: DataFrame, right: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows (feature, value, p, q): the share of each category on either side.

    All features in one shuffle. Shares are of all rows, NULLs included; NULL is
    no category. A category that one side lacks has share 0 there.
    """
    return _distribution(side_counts(left, right, features, []))


def _distribution(counts: DataFrame) -> DataFrame:
    counts = counts.filter(~F.col("is_number")).select("feature", F.col("text").alias("value"), "in_left", "in_right")
    totals = counts.groupBy("feature").agg(
        F.sum("in_left").alias("all_left"), F.sum("in_right").alias("all_right")
    )
    shares = counts.join(F.broadcast(totals), "feature")  # one row per feature
    present = F.col("value").isNotNull()
    shares = shares.select(
        "feature",
        "value",
        F.when(present, F.try_divide("in_left", "all_left")).alias("p"),
        F.when(present, F.try_divide("in_right", "all_right")).alias("q"),
    )
    # Said of the shares, not of the value: a filter on the value would sink below the
    # counting, and the totals, which need the NULLs, would be a second read of both frames.
    return shares.filter(F.col("p").isNotNull() | F.col("q").isNotNull())


def _kl_term(p: Column, q: Column) -> Column:
    """p log2(p / q): 0 where p is 0, infinite where only q is."""
    return (
        F.when(p == 0, F.lit(0.0))
        .when(q == 0, F.lit(float("inf")))
        .otherwise(p * F.log2(p / q))
    )


def kl_divergence(left: DataFrame, right: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows (feature, kl_divergence), in bits, of the left side from the right one."""
    shares = category_distribution(left, right, features)
    return shares.groupBy("feature").agg(F.sum(_kl_term(F.col("p"), F.col("q"))).alias("kl_divergence"))


def js_divergence(
    left: DataFrame, right: DataFrame, features: Sequence[str], strict: bool = False
) -> DataFrame:
    """Rows (feature, js_divergence), in bits, 0 to 1.

    With `strict`, NULL for a feature with a category that only one side has.
    """
    return _js(category_distribution(left, right, features), strict)


def _js(shares: DataFrame, strict: bool = False) -> DataFrame:
    p, q = F.col("p"), F.col("q")
    middle = (p + q) / 2
    score = F.sum((_kl_term(p, middle) + _kl_term(q, middle)) / 2)
    if strict:
        score = F.when(F.count_if((p == 0) | (q == 0)) == 0, score)
    # Without rows there is no distribution; with NULLs only there is nothing to sum.
    return shares.groupBy("feature").agg(score.alias("js_divergence"))


def ks_two_sample(left: DataFrame, right: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows (feature, distance, p_value, n_left, n_right) of the two-sided two-sample test.

    NULL and NaN are left out per feature and side, and of `n_left` and `n_right`. The distance is exact; the p-value
    is the large-sample one. No features give no rows.
    """
    if not features:
        empty = "feature string, distance double, p_value double, n_left bigint, n_right bigint"
        return left.sparkSession.createDataFrame([], empty)
    return _ks(side_counts(left, right, [], features), len(set(features)))


def _ks(counts: DataFrame, features: int) -> DataFrame:
    value = F.when(~F.isnan("number"), F.col("number")).alias("value")
    counts = counts.filter("is_number").select("feature", value, "in_left", "in_right")
    kinds = {"left": F.col("in_left"), "right": F.col("in_right")}
    run = running_counts(counts, "feature", "value", None, kinds, groups=features)
    gap = F.abs(
        F.try_divide("left_upto", "left_total") - F.try_divide("right_upto", "right_total")
    )
    tests = run.groupBy("feature").agg(
        F.max(gap).alias("distance"),
        F.first("left_total").alias("n_left"),
        F.first("right_total").alias("n_right"),
    )
    return tests.select(
        "feature",
        "distance",
        kolmogorov_tail(F.col("distance"), F.col("n_left"), F.col("n_right")).alias("p_value"),
        "n_left",
        "n_right",
    )


def drift_report(
    left: DataFrame,
    right: DataFrame,
    categories: Sequence[str],
    numbers: Sequence[str],
    label: str,
    model_version: int,
    capture_date: dt.date | str | None = None,
) -> DataFrame:
    """The drift log: Jensen-Shannon per category and for the label, Kolmogorov-Smirnov p-value per number.

    Both kinds come from one count of the values, so each side is read once.
    """
    counts = side_counts(left, right, [*categories, label], numbers)
    # Fixed spellings: the log's readers key on them.
    rows = feature_log_rows(_js(_distribution(counts)), "Categorical", "JS_Divergence", F.col("js_divergence"))
    if numbers:
        ks = _ks(counts, len(set(numbers)))
        rows = rows.unionByName(feature_log_rows(ks, "Continous", "KS_Divergence - Pvalue", F.col("p_value")))
    return stamped_feature_log(rows, model_version, capture_date)


def feature_log_rows(scores: DataFrame, category: str, metric: str, value: Column) -> DataFrame:
    return scores.select(
        F.lit(category).alias("Label_category"),
        F.col("feature").alias("Feature_name"),
        F.lit(metric).alias("Metric_name"),
        F.bround(value, 3).alias("Metric_value"),
    )


def stamped_feature_log(
    rows: DataFrame, model_version: int, capture_date: dt.date | str | None
) -> DataFrame:
    return rows.select(
        F.lit(model_version).cast("int").alias("Model_version"),
        "Label_category",
        "Feature_name",
        "Metric_name",
        "Metric_value",
        capture_date_column(capture_date).alias("capture_date"),
    )
