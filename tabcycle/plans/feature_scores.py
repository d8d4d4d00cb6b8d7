"""How much each feature says about the label: chi-square and F tests, and their report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tabcycle.functions.columns import long_form, named, nan_to_null
from tabcycle.functions.tails import chi_square_tail, f_tail
from tabcycle.plans.drift import feature_log_rows, stamped_feature_log


def chi_square_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Rows (feature, p_value, dof, statistic): Pearson's independence test of each feature.

    Features and label are taken as numbers, with any number of values. A row with NULL in a feature or in the
    label is left out for that feature; a feature without rows gives none, and no features give none.

    Rows are counted per value and label first; only these counts go further. A pair that never occurs adds
    what is expected of it: the value's rows times the share of the labels it was never seen with.
    """
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, p_value double, dof bigint, statistic double")
    narrow = df.select(
        named(label).cast("double").alias("__label"), *[named(f).cast("double").alias(f) for f in dict.fromkeys(features)]
    )
    long = long_form(narrow, ["__label"], list(dict.fromkeys(features)), "feature", "value")
    known = long.filter(F.col("value").isNotNull() & F.col("__label").isNotNull())
    cells = known.groupBy("feature", "value", "__label").agg(F.count("*").alias("n"))
    by_label = cells.groupBy("feature", "__label").agg(F.sum("n").alias("of_label"))
    totals = by_label.groupBy("feature").agg(F.sum("of_label").alias("total"), F.count("*").alias("labels"))
    of_value = F.sum("n").over(Window.partitionBy("feature", "value"))
    expected = F.col("of_value").cast("double") * F.col("of_label") / F.col("total")
    # One row per feature. Joined by a shuffle, all cells of a feature would go to one task.
    seen = cells.withColumn("of_value", of_value).join(by_label, ["feature", "__label"]).join(F.broadcast(totals), "feature")
    unseen = F.first("of_value").cast("double") * (F.first("total") - F.sum("of_label")) / F.first("total")
    per_value = seen.groupBy("feature", "value").agg(
        (F.sum((F.col("n") - expected) * (F.col("n") - expected) / expected) + unseen).alias("part"),
        F.first("labels").alias("labels"),
    )
    tests = per_value.groupBy("feature").agg(
        F.sum("part").alias("statistic"),
        ((F.count("*") - 1) * (F.first("labels") - 1)).alias("dof"),
    )
    p_value = chi_square_tail(F.col("statistic"), F.col("dof"))
    return tests.select("feature", p_value.alias("p_value"), "dof", "statistic")


def f_test_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Rows (feature, n, f_value, p_value): the test of the slope of `feature` on the label.

    One pass and one row of moments per task for all features. NULL where the feature or the
    label is constant; no features give no rows. The label is taken as a number, so with two classes this
    is the one-way analysis of variance.
    """
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, n bigint, f_value double, p_value double")
    y = named(label).cast("double")
    rows = []
    for feature in features:
        x = named(feature).cast("double")
        both = x.isNotNull() & y.isNotNull()
        rows.append(
            F.struct(
                F.lit(feature).alias("feature"),
                F.count_if(both).alias("n"),
                F.covar_pop(x, y).alias("xy"),
                F.var_pop(F.when(both, x)).alias("xx"),
                F.var_pop(F.when(both, y)).alias("yy"),
            )
        )
    moments = df.agg(F.array(*rows).alias("rows")).select(F.inline("rows")).filter("n > 0")
    r2 = F.try_divide(F.col("xy") * F.col("xy"), F.col("xx") * F.col("yy"))
    f_value = F.when(F.col("r2") >= 1.0, F.lit(float("inf"))).otherwise(
        F.try_divide("r2", 1.0 - F.col("r2")) * (F.col("n") - 2)
    )
    tests = moments.withColumn("r2", r2).select("feature", "n", f_value.alias("f_value"))
    return tests.withColumn("p_value", f_tail(F.col("f_value"), F.col("n") - 2))


def feature_report(
    df: DataFrame,
    categories: Sequence[str],
    numbers: Sequence[str],
    label: str,
    model_version: int,
    capture_date: dt.date | str | None = None,
) -> DataFrame:
    """The feature-score log: chi-square p-value per category, F-test p-value per number."""
    chi = chi_square_scores(df, categories, label)
    f = f_test_scores(df, numbers, label)
    # Fixed spellings: the log's readers key on them.
    rows = feature_log_rows(chi, "Categorical", "Chi-Square test - pValue", nan_to_null(F.col("p_value")))
    rows = rows.unionByName(
        feature_log_rows(f, "Continous", "Anova test - pValue", nan_to_null(F.col("p_value")))
    )
    return stamped_feature_log(rows, model_version, capture_date)
