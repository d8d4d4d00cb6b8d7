import math
from decimal import Decimal, getcontext

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from plan_text import executed_plan
from tabcycle.functions.tails import erfc, f_tail
from tabcycle.plans.drift import category_distribution, drift_report, js_divergence, kl_divergence, ks_two_sample
from tabcycle.plans.feature_scores import chi_square_scores, f_test_scores, feature_report
from tabcycle.schemas import FEATURE_LOG


def frame(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def test_js_properties(spark):
    a, b = frame(spark, "aaabbc"), frame(spark, "abbccc")
    same = js_divergence(a, a, ["c"]).first().js_divergence
    there, back = (js_divergence(x, y, ["c"]).first().js_divergence for x, y in ((a, b), (b, a)))
    assert same == pytest.approx(0.0, abs=1e-15)
    assert there == pytest.approx(back, abs=1e-12) and 0 < there < 1
    assert js_divergence(frame(spark, "aa"), frame(spark, "bb"), ["c"]).first().js_divergence == pytest.approx(1.0)


def test_js_of_a_one_sided_category(spark):
    a, b = frame(spark, "aab"), frame(spark, "aaa")
    p, q = [2 / 3, 1 / 3], [1.0, 0.0]
    expected = sum(
        x * math.log2(2 * x / (x + y)) / 2 for l, r in ((p, q), (q, p)) for x, y in zip(l, r) if x > 0
    )
    assert js_divergence(a, b, ["c"]).first().js_divergence == pytest.approx(expected, abs=1e-12)
    assert js_divergence(a, b, ["c"], strict=True).first().js_divergence is None
    assert kl_divergence(a, b, ["c"]).first().kl_divergence == float("inf")
    assert kl_divergence(b, a, ["c"]).first().kl_divergence == pytest.approx(math.log2(1.5), abs=1e-12)


def test_null_is_no_category_but_counts_as_a_row(spark):
    a, b = frame(spark, ["a", "a", None, "b"]), frame(spark, ["a", "b"])
    rows = {r.value: (r.p, r.q) for r in category_distribution(a, b, ["c"]).collect()}
    assert rows == {"a": (0.5, 0.5), "b": (0.25, 0.5)}


def test_categories_of_two_types_meet(spark):
    a, b = frame(spark, [1, 0], "int"), frame(spark, [1.0, 0.0], "double")
    assert js_divergence(a, b, ["c"]).first().js_divergence == pytest.approx(0.0, abs=1e-15)
    assert js_divergence(a, frame(spark, ["1", "0"]), ["c", "c"]).first().js_divergence == pytest.approx(0.0, abs=1e-15)


def test_js_reads_each_side_once(spark, tmp_path):
    frame(spark, "aab").write.parquet(str(tmp_path / "a"))
    frame(spark, "abb").write.parquet(str(tmp_path / "b"))
    a, b = (spark.read.parquet(str(tmp_path / side)) for side in "ab")
    plan = executed_plan(js_divergence(a, b, ["c"]))
    assert plan.count("FileScan") == 2 and "NestedLoop" not in plan


def ks_brute(a, b):
    both = np.concatenate([a, b])
    fa = np.searchsorted(np.sort(a), both, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), both, side="right") / len(b)
    return np.abs(fa - fb).max()


def kolmogorov_exact(n, d):
    """P(D_n >= d) for one sample, by Marsaglia, Tsang and Wang's matrix power."""
    k = math.ceil(n * d)
    m, h = 2 * k - 1, k - n * d
    matrix = np.array([[1.0 if i - j + 1 >= 0 else 0.0 for j in range(m)] for i in range(m)])
    for i in range(m):
        matrix[i, 0] -= h ** (i + 1)
        matrix[m - 1, i] -= h ** (m - i)
    matrix[m - 1, 0] += (2 * h - 1) ** m if 2 * h - 1 > 0 else 0
    for i in range(m):
        for j in range(m):
            if i - j + 1 > 0:
                matrix[i, j] /= math.factorial(i - j + 1)
    power = np.linalg.matrix_power(matrix, n)
    value = power[k - 1, k - 1]
    for i in range(1, n + 1):
        value *= i / n
    return 1 - value


def test_ks_distance_is_exact(spark):
    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(0, 1, 900), 2), np.round(rng.normal(0.1, 1.1, 700), 2)
    left = frame(spark, [float(x) for x in a] + [None], "double")
    right = frame(spark, [float(x) for x in b], "double")
    row = ks_two_sample(left, right, ["c"]).first()
    assert row.distance == pytest.approx(ks_brute(a, b), abs=1e-12)
    assert (row.n_left, row.n_right) == (900, 700)
    same = ks_two_sample(left, left, ["c"]).first()
    assert (same.distance, same.p_value) == (0.0, 1.0)
    empty = ks_two_sample(left, right.filter("c > 1000"), ["c"]).first()
    assert (empty.distance, empty.p_value, empty.n_right) == (None, None, 0)


@pytest.mark.parametrize("d", [0.05, 0.08, 0.1, 0.15])
def test_ks_p_value_is_near_the_exact_one(spark, d):
    from tabcycle.functions.tails import kolmogorov_tail

    row = spark.range(1).select(kolmogorov_tail(F.lit(d), F.lit(280), F.lit(280)).alias("p")).first()
    assert row.p == pytest.approx(kolmogorov_exact(140, d), abs=2e-4)


def test_ks_reads_each_side_once(spark, tmp_path):
    frame(spark, [1.0, 2.0], "double").write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    plan = executed_plan(ks_two_sample(stored, stored.filter("c > 0"), ["c"]))
    assert plan.count("FileScan") == 2
    assert "NestedLoop" not in plan and "Exchange SinglePartition" not in plan and "Python" not in plan


def test_ks_leaves_nan_out(spark):
    left, right = frame(spark, [1.0, 2.0, float("nan"), 3.0, None], "double"), frame(spark, [1.0, float("nan"), 4.0], "double")
    row = ks_two_sample(left, right, ["c"]).first()
    assert (row.n_left, row.n_right) == (3, 2) and row.distance == pytest.approx(0.5)


def test_drift_report_reads_each_side_once(spark, tmp_path):
    rows = spark.range(500).selectExpr("string(id % 7) k", "double(id % 90) x", "id z", "int(id % 2) y")
    rows.write.parquet(str(tmp_path / "a"))
    old, new = spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "a")).filter("x > 10")
    plan = executed_plan(drift_report(old, new, ["k", "z"], ["x", "z"], "y", 1, "2024-02-03"))
    assert plan.count("FileScan") == 2 and "SinglePartition" not in plan


def test_drift_report_shape(spark):
    rows = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 0)], "k string, x double, y int")
    report = drift_report(rows, rows, ["k"], ["x"], "y", 7, "2024-02-03")
    assert [(f.name, f.dataType) for f in report.schema] == [(f.name, f.dataType) for f in FEATURE_LOG]
    got = [(r.Label_category, r.Feature_name, r.Metric_name, r.Metric_value) for r in report.collect()]
    assert sorted(got) == [
        ("Categorical", "k", "JS_Divergence", 0.0),
        ("Categorical", "y", "JS_Divergence", 0.0),
        ("Continous", "x", "KS_Divergence - Pvalue", 1.0),
    ]


@pytest.mark.parametrize("z", [0.0, 1e-9, 0.3, 1.0, 1.9999, 2.0, 5.0, 26.0])
def test_erfc(spark, z):
    got = spark.range(1).select(erfc(F.lit(z))).first()[0]
    assert got == pytest.approx(math.erfc(z), rel=1e-12)


def test_f_tail_equals_the_integrated_t_density(spark):
    def integrated(f, df, steps=20000):
        top = math.sqrt(f)
        front = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
        u = np.linspace(0, top, steps + 1)
        y = (1 + u * u / df) ** (-(df + 1) / 2)
        return 1 - 2 * front * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()) * top / steps / 3

    cases = [(f, n) for f in (1e-6, 0.1, 1.0, 3.84, 20.0) for n in (1, 2, 3, 4, 7, 10, 999, 1000, 1001, 60000)]
    df = spark.createDataFrame(cases, "f double, n long").select("f", "n", f_tail(F.col("f"), F.col("n")).alias("p"))
    for r in df.collect():
        assert r.p == pytest.approx(integrated(r.f, r.n), abs=1e-7), (r.f, r.n)
    edges = spark.createDataFrame([(float("inf"), 5), (1.0, 0), (None, 5)], "f double, n long")
    assert [r[0] for r in edges.select(f_tail(F.col("f"), F.col("n"))).collect()] == [0.0, None, None]


def test_f_test_equals_mllib(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 500)
    rows = [(int(v), float(v * 0.2 + rng.normal()), 3.0, float(v)) for v in y]
    df = spark.createDataFrame(rows, "y int, x double, flat double, same double")
    got = {r.feature: r for r in f_test_scores(df, ["x", "flat", "same"], "y").collect()}
    a = np.array([r[1] for r in rows])
    r2 = np.corrcoef(a, y)[0, 1] ** 2
    assert got["x"].f_value == pytest.approx(r2 / (1 - r2) * 498, rel=1e-9)
    assert got["flat"].f_value is None and got["flat"].p_value is None
    assert got["same"].p_value == pytest.approx(0.0, abs=1e-12)


def test_f_test_leaves_out_nulls(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.5), (0, 1.2), (1, None), (None, 5.0)], "y int, x double")
    assert f_test_scores(df, ["x"], "y").first().n == 3


def test_chi_square(spark):
    df = spark.createDataFrame([(1, 1, 1), (0, 0, 1), (1, 0, 1), (0, 0, 1)] * 5, "y int, a int, flat int")
    got = {r.feature: r for r in chi_square_scores(df, ["a", "flat"], "y").collect()}
    assert got["a"].statistic == pytest.approx(20 / 3) and got["a"].dof == 1
    assert got["a"].p_value == pytest.approx(math.erfc(math.sqrt(10 / 3)), abs=1e-10)
    assert (got["flat"].dof, got["flat"].p_value) == (0, 1.0)


def test_feature_report_shape(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (0, 0, 2.0), (1, 0, 1.5), (0, 0, 1.7)] * 5, "y int, a int, x double")
    report = feature_report(df.withColumn("flat", F.lit(2.0)), ["a"], ["x", "flat"], "y", 2, "2024-02-03")
    assert [(f.name, f.dataType) for f in report.schema] == [(f.name, f.dataType) for f in FEATURE_LOG]
    rows = {r.Feature_name: r for r in report.collect()}
    assert rows["a"].Metric_name == "Chi-Square test - pValue" and rows["a"].Metric_value == 0.01
    assert rows["flat"].Metric_value is None and rows["x"].Label_category == "Continous"


def test_f_tail_keeps_its_digits(spark):
    """Even degrees of freedom have a finite sum; in 400 digits nothing cancels."""
    getcontext().prec = 400

    def exact(f, d):
        cos2 = Decimal(d) / (Decimal(d) + Decimal(f))
        term = total = Decimal(1)
        for k in range(1, d // 2):
            term *= cos2 * (2 * k - 1) / (2 * k)
            total += term
        return float(1 - (1 - cos2).sqrt() * total)

    cases = [(f, d) for f in (0.01, 1.0, 4.0, 100.0, 300.0, 1200.0) for d in (2, 4, 10, 998, 1000, 1002, 20000)]
    df = spark.createDataFrame(cases, "f double, n long").select("f", "n", f_tail(F.col("f"), F.col("n")).alias("p"))
    for r in df.collect():
        assert r.p == pytest.approx(exact(r.f, r.n), rel=1e-9, abs=0), (r.f, r.n)


def test_chi_square_of_many_values(spark, jobs):
    """Against MLlib: more than two values and labels, pairs that never occur."""
    rng = np.random.default_rng(8)
    rows = [(int(y), float(x), float(x % 3)) for y, x in zip(rng.integers(0, 3, 400), rng.integers(0, 7, 400)) if x != y]
    df = spark.createDataFrame(rows, "y int, a double, b double")
    scores, started = jobs(lambda: chi_square_scores(df, ["a", "b"], "y"))
    assert started == 0
    wanted = ChiSquareTest.test(VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df), "f", "y", True)
    for got, want in zip(scores.orderBy("feature").collect(), wanted.orderBy("featureIndex").collect(), strict=True):
        assert got.dof == want.degreesOfFreedom and got.statistic == pytest.approx(want.statistic, rel=1e-12)
        assert got.p_value == pytest.approx(want.pValue, rel=1e-9, abs=1e-13)
    with_null = df.union(spark.createDataFrame([(1, None, 2.0), (None, 3.0, 1.0)], df.schema))
    assert {r.feature: r.statistic for r in chi_square_scores(with_null, ["a"], "y").collect()}["a"] == pytest.approx(
        scores.filter("feature = 'a'").first().statistic
    )
