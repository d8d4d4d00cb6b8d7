"""Exact splits, wide encoding, idempotent logs, tails of many degrees of freedom."""

import math
import re
from collections import Counter
from decimal import Decimal, getcontext

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabcycle.functions.tails import chi_square_tail
from tabcycle.operators.split import kth_draws, stratified_split
from tabcycle.operators.wide_encoder import WideOneHot, WideOneHotModel
from tabcycle.plans.feature_scores import chi_square_scores
from tabcycle.schemas import FEATURE_LOG
from tabcycle.sources import tables


@pytest.mark.parametrize(("n", "share"), [(1, 0.5), (7, 0.7), (1000, 0.7), (1000, 1.0), (999, 0.001), (20_000, 0.333)])
def test_exact_split_is_right_to_the_row(spark, n, share):
    df = spark.range(n).selectExpr("id", "int(id % 3 = 0) y").repartition(5)
    train, test = stratified_split(df, "y", train=share, test=1 - share, key_columns=["id"], mode="exact")
    sizes = {r.y: r["count"] for r in df.groupBy("y").count().collect()}
    got = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    assert all(got.get(y, 0) == math.floor(size * share + 0.5) for y, size in sizes.items())
    assert train.unionByName(test).count() == n and train.join(test, "id").count() == 0
    again, _ = stratified_split(df.repartition(2), "y", train=share, test=1 - share, key_columns=["id"], mode="exact")
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in train.collect())


def test_exact_split_keeps_repeated_keys_together(spark):
    df = spark.range(60).selectExpr("id div 6 AS k", "0 AS y")
    train, test = stratified_split(df, "y", key_columns=["k"], mode="exact")
    assert train.count() == 42 and train.join(test, "k").count() == 0
    with pytest.raises(ValueError, match="key_columns"):
        stratified_split(df, "y", mode="exact")


def test_kth_draw_among_equal_starts(spark):
    draws = [f"0000{i % 3:04x}{i:024x}" for i in range(90)] + ["ffffffff" + "0" * 24] * 10
    df = spark.createDataFrame([(0, d) for d in draws], "g int, d string")
    for share in (0.0, 0.11, 0.5, 0.89, 0.95, 1.0):
        k = math.floor(100 * share + 0.5)
        assert kth_draws(df, "g", "d", share) == ({0: sorted(draws)[k]} if k < 100 else {})


def sparse(row):
    return row.indices.tolist(), row.values.tolist(), row.size


def test_wide_one_hot_of_100_000_values(spark, jobs):
    df = spark.range(300_000).selectExpr("id", "concat('v', id % 100000) AS v")
    model = WideOneHot(inputCols=["v"]).fit(df)
    slots = model.slots(spark)
    assert slots.count() == 100_000
    expected = {f"v{i}": n for n, i in enumerate(sorted(range(100_000), key=lambda i: f"v{i}"))}
    assert {r.value: r.slot for r in slots.collect()} == expected
    out, started = jobs(lambda: model.transform(df))
    assert started == 0 and out.count() == 300_000
    for r in out.filter("id % 9973 = 0").collect():
        assert r.v_slot == expected[r.v] and sparse(r.v_vector) == ([r.v_slot], [1.0], 100_000)
    assert out.filter("v_slot IS NULL").count() == 0


def test_wide_one_hot_edge_cases_and_saving(spark, tmp_path):
    df = spark.createDataFrame([(1, "b", 2), (2, None, 1), (3, "a b", 2), (4, "ab", None), (5, "", 10)], "id int, `c d` string, n int")
    model = WideOneHot(inputCols=["c d", "n"], excludeCategories={"n": ["1"]}, dropOriginal=True).fit(df)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(loaded.stages[0], WideOneHotModel) and loaded.stages[0].getOrDefault("slotTable").startswith(str(tmp_path))
    new = df.union(spark.createDataFrame([(6, "never seen", 10)], df.schema))
    for stage in (model, loaded):
        rows = {r.id: r for r in stage.transform(new).collect()}
        assert set(stage.transform(new).columns) == {"id", "c d_slot", "c d_vector", "n_slot", "n_vector"}
        assert {i: (r["c d_slot"], r["n_slot"]) for i, r in rows.items()} == {
            1: (3, 1), 2: (None, None), 3: (1, 1), 4: (2, None), 5: (0, 0), 6: (None, 0)
        }
        assert sparse(rows[3]["c d_vector"]) == ([1], [1.0], 4) and sparse(rows[6]["c d_vector"]) == ([], [], 4)
    nothing = WideOneHot(inputCols=["n"]).fit(df.filter("id > 9"))
    assert nothing.slots(spark).count() == 0


def test_a_run_written_again_replaces_itself(spark, tmp_path):
    def log(value):
        rows = [(1, "c", "f", "m", value, d) for d in ("2024-01-01", "2024-01-02")]
        return spark.createDataFrame(rows, "Model_version int, Label_category string, Feature_name string, Metric_name string, Metric_value double, d string").withColumn("capture_date", F.to_date("d")).drop("d")

    location = str(tmp_path / "log")
    for run, value in (("a", 1.0), ("b", 2.0), ("a", 3.0), (None, 4.0), (None, 4.0)):
        tables.append_log(log(value), location, run)
    read = tables.read_log(spark, location, FEATURE_LOG)
    assert read.schema == FEATURE_LOG
    assert Counter(r.Metric_value for r in read.collect()) == {3.0: 2, 2.0: 2, 4.0: 4}
    assert [r.Metric_value for r in tables.read_log(spark, location, FEATURE_LOG, "a").collect()] == [3.0, 3.0]


def gamma_q(a: int, x: float) -> Decimal:
    """Q(a, x) for whole a: e^-x sum of x^j / j! below a, from its largest term down."""
    getcontext().prec = 60
    a_, x_ = Decimal(a), Decimal(x)
    # log Gamma(a), by Stirling's series from 50 further up.
    up, shift = a_, Decimal(0)
    while up < a_ + 50:
        shift += up.ln()
        up += 1
    pi = Decimal("3.14159265358979323846264338327950288419716939937510582097494")
    series = sum(Decimal(c) / d / up**k for c, d, k in ((1, 12, 1), (-1, 360, 3), (1, 1260, 5), (-1, 1680, 7), (1, 1188, 9)))
    log_gamma = (up - Decimal("0.5")) * up.ln() - up + (2 * pi).ln() / 2 + series - shift
    head = (-x_ + (a_ - 1) * x_.ln() - log_gamma).exp()
    if x >= a:
        steps = min(a - 1, int(14 * math.sqrt(a)) + 400)
        ratios = (a - 1 - np.arange(steps, dtype=np.longdouble)) / np.longdouble(x)
        return head * Decimal(float(1 + np.cumprod(ratios).sum()))
    # Below the mean: 1 - P, whose series goes up.
    steps = int(14 * math.sqrt(a)) + 400
    ratios = np.longdouble(x) / (a + 1 + np.arange(steps, dtype=np.longdouble))
    return 1 - head * x_ / a_ * Decimal(float(1 + np.cumprod(ratios).sum()))


def test_chi_square_tail_from_one_to_a_billion_degrees(spark):
    cases = []
    for dof in (2, 4, 64, 126, 128, 130, 132, 200, 1000, 10_000, 10**6, 10**7, 4 * 10**8, 10**9):
        for z in (-6, -3, -1, -0.01, 0.0, 0.01, 0.5, 1, 3, 6, 15, 30):
            x = dof + z * math.sqrt(2 * dof)
            if x > 0:
                cases.append((dof, x, float(gamma_q(dof // 2, x / 2))))
    df = spark.createDataFrame([(d, x, q) for d, x, q in cases], "d bigint, x double, q double").repartition(8)
    bad = df.select("d", "x", "q", chi_square_tail(F.col("x"), F.col("d")).alias("p")).filter("p IS NULL OR abs(p / q - 1) > 1e-9")
    assert bad.collect() == []


def test_chi_square_tail_of_odd_degrees_goes_on_smoothly(spark):
    rows = spark.createDataFrame([(d, d + z * math.sqrt(2 * d)) for d in range(121, 137) for z in (-2.0, 0.0, 2.0, 8.0)], "d bigint, x double")
    tails = {(r.d, round((r.x - r.d) / math.sqrt(2 * r.d), 6)): r.p for r in rows.select("d", "x", chi_square_tail(F.col("x"), F.col("d")).alias("p")).collect()}
    for z in (-2.0, 0.0, 2.0, 8.0):
        logs = [math.log(tails[d, z]) for d in range(121, 137)]
        # The third differences are some 4e-6 and change slowly; a step between the two formulas would stand out.
        assert np.abs(np.diff(logs, 4)).max() < 2e-7


def test_chi_square_does_not_deal_cells_by_feature_alone(spark):
    rows = spark.range(1000).selectExpr("id % 50 AS a", "id % 7 AS b", "id % 3 AS y")
    names = ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"]
    old = {name: spark.conf.get(name) for name in names}
    try:
        # As the plan stands before any size is known.
        for name, value in zip(names, ("false", "-1"), strict=True):
            spark.conf.set(name, value)
        plan = chi_square_scores(rows, ["a", "b"], "y")._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    assert not re.search(r"SortMergeJoin \[feature#\d+\]", plan) and "BroadcastHashJoin [feature#" in plan
