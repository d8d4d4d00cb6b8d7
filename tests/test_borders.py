"""Sizes at which a plan changes must not change rows or types; empty lists give empty frames."""

import pytest

from tabcycle.functions.text import one_type, translate_values
from tabcycle.operators.encoders import OneHotColumns
from tabcycle.operators.split import stratified_split
from tabcycle.plans.drift import drift_report, ks_two_sample
from tabcycle.plans.feature_scores import chi_square_scores, f_test_scores, feature_report


@pytest.mark.parametrize("last", [7, 4.5, None])
def test_translation_is_the_same_on_both_sides_of_the_border(spark, last):
    rows = spark.range(4).selectExpr("cast(id AS int) AS k")
    small = {n: n for n in range(255)} | {300: last}
    large = {n: n for n in range(256)} | {300: last}
    frames = [translate_values(rows, "k", mapping, "v") for mapping in (small, large)]
    assert frames[0].dtypes == frames[1].dtypes
    assert frames[0].collect() == frames[1].collect()


def test_types_of_mappings():
    assert (one_type([1, None]), one_type([1 << 40]), one_type([1, 2.5]), one_type(["a"])) == ("int", "bigint", "double", "string")
    with pytest.raises(ValueError, match="text and numbers"):
        one_type([1, "a"])


def test_more_than_a_thousand_categories(spark):
    rows = spark.range(1001).selectExpr("concat('v', id) AS c")
    assert len(OneHotColumns(inputCols=["c"]).fit(rows).transform(rows.limit(1)).columns) == 1000


def test_empty_lists(spark):
    rows = spark.range(20).selectExpr("cast(id % 2 AS int) AS y", "concat('c', id % 3) AS c", "id % 2 AS x")
    assert ks_two_sample(rows, rows, []).count() == chi_square_scores(rows, [], "y").count() == 0
    assert f_test_scores(rows, [], "y").count() == 0
    assert drift_report(rows, rows, ["c"], [], "y", 1).count() == 2
    assert feature_report(rows, ["x"], [], "y", 1).count() == 1
    assert OneHotColumns(inputCols=[]).fit(rows).transform(rows).columns == rows.columns


def test_split_without_a_key_keeps_the_ratio_of_equal_rows(spark):
    rows = spark.range(4000).selectExpr("1 AS y")
    train, test = stratified_split(rows, "y")
    assert abs(train.count() - 2800) < 150 and train.count() + test.count() == 4000
    with pytest.raises(ValueError, match="key_columns"):
        stratified_split(rows, "y", mode="hash")
