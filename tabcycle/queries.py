"""Every operator as a query over the test tables, next to the SQL that gives the same rows.

Floats are rounded on both sides: sums differ in the last bits between engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabcycle.functions.columns import column_types, columns_of_type, shape_frame
from tabcycle.functions.text import regex_first, translate_values
from tabcycle.operators.assembly import FeatureAssembly
from tabcycle.operators.encoders import CastColumns, DropColumns, OneHotColumns, OrdinalMap, RegexNumber
from tabcycle.operators.inference import ModelInference
from tabcycle.operators.reports import FeatureScores, ModelScores
from tabcycle.operators.split import class_rows, stratified_split, unlabelled_rows
from tabcycle.operators.wide_encoder import WideOneHot
from tabcycle.plans.curves import average_precision, roc_auc
from tabcycle.plans.cutoffs import cutoff_table, select_cutoff
from tabcycle.plans.drift import category_distribution, drift_report, js_divergence, kl_divergence, ks_two_sample
from tabcycle.plans.experiment import GRIDS, Experiment, TrainConfig, run_experiment, tune_cutoff
from tabcycle.plans.feature_scores import chi_square_scores, f_test_scores
from tabcycle.plans.metrics import confusion_counts, many_model_scores, model_scores, pivot_log, union_logs
from tabcycle.plans.model_scoring import score_by_rows
from tabcycle.plans.recipe import survey_recipe
from tabcycle.schemas import FEATURE_LOG, METRIC_LOG
from tabcycle.sources.artifacts import read_threshold, write_threshold
from tabcycle.sources.models import model_rows
from tabcycle.sources.shared import shared_folder
from tabcycle.sources.tables import append_log, read_log, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CAPTURED = "2024-01-01"
LABEL_NAMES = {0: "kept", 1: "returned"}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", columns=columns)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as scored rows: two scores, their predictions, and returned or not as the label."""
    lines = table(spark, sf_dir, "lineitem", "l_quantity", "l_extendedprice", "l_returnflag")
    lines = lines.select(
        (F.col("l_quantity") / 50).alias("by_quantity"),
        (F.col("l_extendedprice") / 105000).alias("by_price"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
    )
    return lines.withColumns(
        {f"called_{s}": (F.col(s) >= 0.5).cast("double") for s in ("by_quantity", "by_price")}
    )


SCORED = """scored AS (
  SELECT l_quantity / 50 AS by_quantity, l_extendedprice / 105000 AS by_price,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y
  FROM lineitem)"""


def quantity_model() -> PipelineModel:
    """A model whose probability is a plain expression, so that SQL can follow it."""
    rule = SQLTransformer(
        statement="SELECT *, 1 - l_quantity / 50 AS q0, l_quantity / 50 AS q1, "
        "CAST(l_quantity >= 25 AS DOUBLE) AS prediction FROM __THIS__"
    )
    return PipelineModel([rule, VectorAssembler(inputCols=["q0", "q1"], outputCol="probability")])


def old_and_new_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(
        spark, sf_dir, "orders", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice", "o_custkey"
    ).withColumn("is_f", (F.col("o_orderstatus") == "F").cast("int"))
    new = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return orders.filter(~new), orders.filter(new)


# Schema and projection


@query(
    "SELECT 'lineitem' AS table_name, count(*) AS rows, 11 AS columns FROM lineitem"
)
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_frame(table(spark, sf_dir, "lineitem")).select(
        F.lit("lineitem").alias("table_name"), "rows", "columns"
    )


@query(
    """SELECT column_name, data_type, is_text, filled FROM (
  SELECT unnest([
    {'column_name': 'p_partkey', 'data_type': 'bigint', 'is_text': false, 'filled': count(p_partkey)},
    {'column_name': 'p_name', 'data_type': 'string', 'is_text': true, 'filled': count(p_name)},
    {'column_name': 'p_brand', 'data_type': 'string', 'is_text': true, 'filled': count(p_brand)},
    {'column_name': 'p_type', 'data_type': 'string', 'is_text': true, 'filled': count(p_type)},
    {'column_name': 'p_size', 'data_type': 'int', 'is_text': false, 'filled': count(p_size)},
    {'column_name': 'p_retailprice', 'data_type': 'double', 'is_text': false, 'filled': count(p_retailprice)}
  ], recursive := true) FROM part)"""
)
def type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    texts = columns_of_type(part, "string")
    columns = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind.simpleString()).alias("data_type"),
            F.lit(name in texts).alias("is_text"),
            F.count(name).alias("filled"),
        )
        for name, kind in column_types(part).items()
    ]
    return part.agg(F.array(*columns).alias("columns")).select(F.inline("columns"))


@query(
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
  CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS DOUBLE) AS l_suppkey FROM lineitem"""
)
def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey")
    return CastColumns(types={"l_quantity": "int", "l_partkey": "string", "l_suppkey": "double"}).transform(lines)


@query("SELECT p_partkey, p_type, TRY_CAST(p_brand AS INTEGER) AS p_brand FROM part")
def cast_columns_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part", "p_partkey", "p_type", "p_brand")
    return CastColumns(types={"p_brand": "int"}, safe=True).transform(part)


@query("SELECT * EXCLUDE (l_shipdate, l_tax) FROM lineitem")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DropColumns(cols=["l_shipdate", "l_tax", "no_such_column"]).transform(table(spark, sf_dir, "lineitem"))


@query("SELECT p_partkey, CAST(p_size AS DOUBLE) AS slot_0, p_retailprice AS slot_1, 2 AS slots FROM part")
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    assembled = FeatureAssembly(excludeCols=["p_partkey"]).fit(part).transform(part)
    slots = vector_to_array("features")
    return assembled.select(
        "p_partkey", slots[0].alias("slot_0"), slots[1].alias("slot_1"), F.size(slots).alias("slots")
    )


# Encoders


@query(
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END AS "c_mktsegment_AUTOMOBILE",
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS "c_mktsegment_BUILDING",
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS "c_mktsegment_FURNITURE",
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS "c_mktsegment_HOUSEHOLD"
FROM customer"""
)
def one_hot_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return OneHotColumns(inputCols=["c_mktsegment"]).fit(customer).transform(customer)


@query(
    """SELECT o_orderkey, o_orderpriority,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS "o_orderpriority_1URGENT",
  CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS "o_orderpriority_2HIGH",
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS "o_orderpriority_3MEDIUM",
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS "o_orderpriority_4NOT_SPECIFIED",
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS "o_orderstatus_F",
  CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS "o_orderstatus_O",
  CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS "o_orderstatus_P"
FROM orders"""
)
def one_hot_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    encoder = OneHotColumns(
        inputCols=["o_orderpriority", "o_orderstatus"],
        excludeCategories={"o_orderpriority": ["5-LOW"]},
        dropCols=["o_orderstatus"],
        dropLast=False,
    )
    return encoder.fit(orders).transform(orders)


@query(
    """SELECT l_orderkey, l_linenumber, slot AS l_partkey_slot, (SELECT count(DISTINCT l_partkey) - 1 FROM lineitem) AS size,
  CASE WHEN slot IS NULL THEN [] ELSE [slot] END AS indices
FROM lineitem LEFT JOIN (SELECT l_partkey, row_number() OVER (ORDER BY CAST(l_partkey AS VARCHAR)) - 1 AS slot
  FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey <> 7)) USING (l_partkey)"""
)
def wide_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    encoder = WideOneHot(inputCols=["l_partkey"], excludeCategories={"l_partkey": ["7"]}, dropOriginal=True)
    vector = F.from_json(F.to_json(F.struct("l_partkey_vector")), "l_partkey_vector struct<size: bigint, indices: array<bigint>>")
    coded = encoder.fit(lines).transform(lines)
    return coded.select("l_orderkey", "l_linenumber", "l_partkey_slot", vector["l_partkey_vector"].alias("v")).select(
        "l_orderkey", "l_linenumber", "l_partkey_slot", "v.size", "v.indices"
    )


@query(
    """SELECT o_orderkey, o_orderstatus, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4.5
    WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 1 ELSE 0 END AS FLOAT) AS o_orderpriority_transformed
FROM orders"""
)
def ordinal_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    levels = {"1-URGENT": 5, "2-HIGH": 4.5, "3-MEDIUM": 3, "5-LOW": 1}
    return OrdinalMap(mappings={"o_orderpriority": levels}).transform(orders)


@query(
    """SELECT o_orderkey, o_orderpriority, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 5
    WHEN '2-HIGH' THEN 4.5 END AS FLOAT) AS o_orderpriority_transformed
FROM orders"""
)
def ordinal_unfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    mapping = {"o_orderpriority": {"1-URGENT": 5, "2-HIGH": 4.5}}
    return OrdinalMap(mappings=mapping, replaceNa=False, dropOriginal=False).transform(orders)


@query(
    """SELECT c_custkey, c_mktsegment,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'cars' WHEN 'MACHINERY' THEN 'tools' END AS segment_group
FROM customer"""
)
def translate_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return translate_values(customer, "c_mktsegment", {"AUTOMOBILE": "cars", "MACHINERY": "tools"}, "segment_group")


@query(
    """SELECT p_partkey, p_name, TRY_CAST(nullif(regexp_extract(p_brand, '[0-9]+'), '') AS FLOAT)
  AS p_brand_transformed FROM part"""
)
def regex_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand")
    return RegexNumber(inputCols=["p_brand"], pattern="[0-9]+").transform(part)


@query(
    """SELECT o_orderkey, o_orderpriority, o_orderstatus,
  TRY_CAST(regexp_extract(o_orderpriority, '^.{0,1}') AS FLOAT) AS o_orderpriority_transformed,
  TRY_CAST(regexp_extract(o_orderstatus, '^.{0,1}') AS FLOAT) AS o_orderstatus_transformed FROM orders"""
)
def regex_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    stage = RegexNumber(inputCols=["o_orderpriority", "o_orderstatus"], pattern="^.{0,1}", dropOriginal=False)
    return stage.transform(orders)


@query(
    """SELECT event_id, event_type, CAST(len(regexp_extract_all(props, '[0-9]')) AS INTEGER) AS digits,
  array_to_string(regexp_extract_all(props, '[0-9]'), '|') AS found FROM events"""
)
def regex_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events", "event_id", "event_type", "props")
    found = RegexNumber(inputCols=["props"], pattern="[0-9]", firstOnly=False).transform(events)
    hits = F.col("props_transformed")
    return found.select(
        "event_id", "event_type", F.size(hits).alias("digits"), F.array_join(hits, "|").alias("found")
    )


@query(
    """SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(\\w+) bolt')
  THEN regexp_extract(p_name, '(\\w+) bolt', 1) END AS bolt_colour FROM part"""
)
def regex_group_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part", "p_partkey", "p_name")
    return part.select("p_partkey", regex_first(F.col("p_name"), r"(\w+) bolt", as_number=False).alias("bolt_colour"))


_SURVEY_ANSWERS = {
    "HeartDisease": ("l_returnflag = 'R'", "Yes", "No"),
    "Smoking": ("l_linestatus = 'O'", "Yes", "No"),
    "AlcoholDrinking": ("l_quantity > 45", "Yes", "No"),
    "Stroke": ("l_tax = 0", "Yes", "No"),
    "DiffWalking": ("l_discount > 0.08", "Yes", "No"),
    "Sex": ("l_linenumber > 3", "Female", "Male"),
    "PhysicalActivity": ("l_quantity < 30", "Yes", "No"),
    "Asthma": ("l_discount < 0.02", "Yes", "No"),
    "KidneyDisease": ("l_tax > 0.07", "Yes", "No"),
    "SkinCancer": ("l_extendedprice > 90000", "Yes", "No"),
}
_RACE = """CASE l_linenumber WHEN 1 THEN 'White' WHEN 2 THEN 'Black' WHEN 3 THEN 'Asian' WHEN 4 THEN 'Hispanic'
  WHEN 5 THEN 'American Indian/Alaskan Native' ELSE 'Other' END"""
_DIABETIC = """CASE WHEN l_discount < 0.02 THEN 'Yes' WHEN l_discount < 0.04 THEN 'Yes (during pregnancy)'
  WHEN l_discount < 0.06 THEN 'No, borderline diabetes' ELSE 'No' END"""
_HEALTH = """CASE WHEN l_quantity < 10 THEN 'Excellent' WHEN l_quantity < 20 THEN 'Very good' WHEN l_quantity < 30 THEN 'Good'
  WHEN l_quantity < 40 THEN 'Fair' ELSE 'Poor' END"""
_AGE = "CASE WHEN l_linenumber > 5 THEN '80 or older' WHEN l_linenumber > 2 THEN '45-49' ELSE '18-24' END"
_SURVEY = "SELECT l_orderkey, l_linenumber, " + ", ".join(
    [f"CASE WHEN {test} THEN '{yes}' ELSE '{no}' END AS {c}" for c, (test, yes, no) in _SURVEY_ANSWERS.items()]
    + [f"{_RACE} AS Race", f"{_DIABETIC} AS Diabetic", f"{_HEALTH} AS GenHealth", f"{_AGE} AS AgeCategory"]
    + ["l_extendedprice AS BMI", "l_quantity AS PhysicalHealth", "l_tax AS MentalHealth", "l_discount AS SleepTime"]
    + ["l_shipdate AS capture_date"]
)
_SURVEY_SQL = (
    f"WITH survey AS ({_SURVEY} FROM lineitem) SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"CASE WHEN {c} = '{yes}' THEN 1 ELSE 0 END AS \"{c}_{yes}\"" for c, (_, yes, _no) in _SURVEY_ANSWERS.items()
    )
    + """,
  CASE WHEN Diabetic = 'Yes (during pregnancy)' THEN 1 ELSE 0 END AS "Diabetic_Yes_during_pregnancy",
  CASE WHEN Race = 'American Indian/Alaskan Native' THEN 1 ELSE 0 END AS "Race_American_IndianAlaskan_Native",
  CASE WHEN Race = 'Asian' THEN 1 ELSE 0 END AS "Race_Asian",
  CASE WHEN Race = 'Black' THEN 1 ELSE 0 END AS "Race_Black",
  CASE WHEN Race = 'Hispanic' THEN 1 ELSE 0 END AS "Race_Hispanic",
  CASE WHEN Race = 'White' THEN 1 ELSE 0 END AS "Race_White",
  BMI AS "BMI", PhysicalHealth AS "PhysicalHealth", MentalHealth AS "MentalHealth", SleepTime AS "SleepTime",
  CAST(CASE GenHealth WHEN 'Excellent' THEN 5 WHEN 'Very good' THEN 4.5 WHEN 'Good' THEN 4 WHEN 'Fair' THEN 3
    ELSE 2 END AS FLOAT) AS "GenHealth_transformed",
  CAST(CASE Diabetic WHEN 'No, borderline diabetes' THEN 1 WHEN 'Yes' THEN 3 ELSE 0 END AS FLOAT)
    AS "Diabetic_transformed",
  CAST(substr(AgeCategory, 1, 2) AS FLOAT) AS "AgeCategory_transformed"
FROM survey"""
)


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the shape of the heart-disease survey."""
    return SQLTransformer(statement=_SURVEY + " FROM __THIS__").transform(table(spark, sf_dir, "lineitem"))


@query(_SURVEY_SQL)
def survey_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = survey(spark, sf_dir)
    return survey_recipe(assemble=False).fit(rows).transform(rows)


@query(_SURVEY_SQL)
def saved_recipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recipe as `survey_features`, fitted, saved, and applied by what was loaded."""
    rows = survey(spark, sf_dir)
    location = f"{shared_folder(spark)}/recipe-{uuid.uuid4().hex}"
    survey_recipe(assemble=False).fit(rows).write().save(location)
    return PipelineModel.load(location).transform(rows)


# Split


@query(
    """SELECT o_orderkey, o_orderstatus, is_f,
  CASE WHEN CAST(concat('0x', substr(md5(concat('42', chr(1), CAST(o_orderkey AS VARCHAR))), 1, 8)) AS BIGINT)
    / 4294967296.0 < 0.7 THEN 'train' ELSE 'test' END AS side
FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_f FROM orders)"""
)
def split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    orders = orders.withColumn("is_f", (F.col("o_orderstatus") == "F").cast("int"))
    train, test = stratified_split(orders, "is_f", key_columns=["o_orderkey"])
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query(
    """SELECT 'negative' AS part, count(*) FILTER (l_linenumber = 0) AS n FROM lineitem UNION ALL
SELECT 'positive', count(*) FILTER (l_linenumber = 1) FROM lineitem UNION ALL
SELECT 'left out', count(*) FILTER (l_linenumber NOT IN (0, 1)) FROM lineitem"""
)
def split_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_linenumber")
    parts = [
        class_rows(lines, "l_linenumber", 0).agg(F.count("*").alias("n")).withColumn("part", F.lit("negative")),
        class_rows(lines, "l_linenumber", 1).agg(F.count("*").alias("n")).withColumn("part", F.lit("positive")),
        unlabelled_rows(lines, "l_linenumber").select(F.col("unlabelled").alias("n"), F.lit("left out").alias("part")),
    ]
    return union_logs(parts).select("part", "n")


@query(
    """SELECT o_orderkey, o_orderstatus, is_f, CASE WHEN nth <= floor(size * 0.7::DOUBLE + 0.5) THEN 'train' ELSE 'test' END AS side
FROM (SELECT *, row_number() OVER (PARTITION BY is_f ORDER BY draw) AS nth, count(*) OVER (PARTITION BY is_f) AS size
  FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_f,
          md5(concat('42', chr(1), CAST(o_orderkey AS VARCHAR))) AS draw FROM orders))"""
)
def split_orders_exactly(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    orders = orders.withColumn("is_f", (F.col("o_orderstatus") == "F").cast("int"))
    train, test = stratified_split(orders, "is_f", key_columns=["o_orderkey"], mode="exact")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


# Scoring and metrics


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity / 50 AS prob_raw,
  CASE WHEN l_quantity / 50 >= 0.3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction_with_threshold,
  CASE WHEN l_quantity >= 25 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM lineitem"""
)
def apply_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    stage = ModelInference(model=quantity_model(), applyCutoff=True, cutoff=0.3)
    return stage.transform(lines).select("l_orderkey", "l_linenumber", "prob_raw", "prediction_with_threshold", "prediction")


@query(
    f"""WITH {SCORED} SELECT CAST(y AS DOUBLE) AS label, CASE WHEN by_quantity >= 0.5 THEN 1.0::DOUBLE
  ELSE 0.0::DOUBLE END AS prediction, count(*) AS n FROM scored GROUP BY ALL"""
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_counts(scored_lines(spark, sf_dir), "y", "called_by_quantity")


def _curve_sql(score: str, metric: str) -> str:
    sums = {
        "roc_auc": "sum(neg * (above + pos / 2.0)) / (max(p) * max(n))",
        "avg_pr": "sum(pos * (above + pos) / (above + pos + neg_above + neg)) / max(p)",
    }
    return f"""SELECT '{score}' AS curve, round({sums[metric]}, 6) AS {metric} FROM (
  SELECT pos, neg, sum(pos) OVER () AS p, sum(neg) OVER () AS n,
    CAST(coalesce(sum(pos) OVER w, 0) AS DOUBLE) AS above, CAST(coalesce(sum(neg) OVER w, 0) AS DOUBLE) AS neg_above
  FROM (SELECT {score} AS s, CAST(count(*) FILTER (y = 1) AS DOUBLE) AS pos,
          CAST(count(*) FILTER (y = 0) AS DOUBLE) AS neg FROM scored GROUP BY 1)
  WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query(f"WITH {SCORED} {_curve_sql('by_quantity', 'roc_auc')} UNION ALL {_curve_sql('by_price', 'roc_auc')}")
def roc_auc_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(roc_auc(scored_lines(spark, sf_dir), "y", ["by_quantity", "by_price"]), "roc_auc")


@query(f"WITH {SCORED} {_curve_sql('by_quantity', 'avg_pr')} UNION ALL {_curve_sql('by_price', 'avg_pr')}")
def average_precision_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(average_precision(scored_lines(spark, sf_dir), "y", ["by_quantity", "by_price"]), "avg_pr")


def _metrics_sql(score: str) -> str:
    return f"""SELECT 1 AS "Model_version", category AS "Label_category", metric AS "Metric_name",
  round(value, 6) AS "Metric_value", '{score}' AS classifier, DATE '{CAPTURED}' AS capture_date
FROM (
  WITH cells AS (SELECT y, CASE WHEN {score} >= 0.5 THEN 1 ELSE 0 END AS c, CAST(count(*) AS DOUBLE) AS n
                 FROM scored GROUP BY ALL),
  classes AS (SELECT k, (SELECT sum(n) FROM cells) AS total,
      (SELECT coalesce(sum(n), 0) FROM cells WHERE y = k) AS size,
      (SELECT coalesce(sum(n), 0) FROM cells WHERE c = k) AS called,
      (SELECT coalesce(sum(n), 0) FROM cells WHERE y = k AND c = k) AS hit FROM (VALUES (0), (1)) v(k)),
  rates AS (SELECT *, CASE WHEN called = 0 THEN 0 ELSE hit / called END AS p, hit / size AS r,
      (called - hit) / (total - size) AS fpr FROM classes),
  f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1,
      CASE WHEN p + r = 0 THEN 0 ELSE 1.25 * p * r / (0.25 * p + r) END AS fh FROM rates)
  SELECT CASE k WHEN 1 THEN 'returned' ELSE 'kept' END AS category, 'precision' AS metric, p AS value FROM f
  UNION ALL SELECT CASE k WHEN 1 THEN 'returned' ELSE 'kept' END, 'recall', r FROM f
  UNION ALL SELECT CASE k WHEN 1 THEN 'returned' ELSE 'kept' END, 'F1 Measure', f1 FROM f
  UNION ALL SELECT 'Weighted_Overall', 'Weighted recall', sum(r * size / total) FROM f
  UNION ALL SELECT 'Weighted_Overall', 'Accuracy', sum(hit / total) FROM f
  UNION ALL SELECT 'Weighted_Overall', 'Weighted precision', sum(p * size / total) FROM f
  UNION ALL SELECT 'Weighted_Overall', 'Weighted F(1) Score', sum(f1 * size / total) FROM f
  UNION ALL SELECT 'Weighted_Overall', 'Weighted F(0.5) Scores', sum(fh * size / total) FROM f
  UNION ALL SELECT 'Weighted_Overall', 'Weighted false positive rate', sum(fpr * size / total) FROM f
  UNION ALL SELECT 'Weighted_Overall', 'roc_auc', roc_auc FROM ({_curve_sql(score, 'roc_auc')})
  UNION ALL SELECT 'Weighted_Overall', 'avg_pr', avg_pr FROM ({_curve_sql(score, 'avg_pr')}))"""


def quantity_scores(spark: SparkSession, sf_dir: str, score: str = "by_quantity") -> DataFrame:
    return model_scores(
        scored_lines(spark, sf_dir), f"called_{score}", "y", LABEL_NAMES, score, 1, score, CAPTURED
    )


@query(f"WITH {SCORED} {_metrics_sql('by_quantity')}")
def model_scores_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = ModelScores(
        predictionCol="called_by_quantity", labelCol="y", labelNames=LABEL_NAMES, scoreCol="by_quantity",
        modelVersion=1, modelName="by_quantity", captureDate=CAPTURED,
    )
    return rounded(stage.transform(scored_lines(spark, sf_dir)), "Metric_value")


@query(
    f"""WITH {SCORED}, log AS ({_metrics_sql('by_quantity')} UNION ALL {_metrics_sql('by_price')})
SELECT "Model_version", "Label_category", "Metric_name", capture_date,
  round(sum("Metric_value") FILTER (classifier = 'by_quantity'), 5) AS by_quantity,
  round(sum("Metric_value") FILTER (classifier = 'by_price'), 5) AS by_price
FROM log GROUP BY ALL"""
)
def metric_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = {score: (f"called_{score}", score) for score in ("by_quantity", "by_price")}
    log = many_model_scores(scored_lines(spark, sf_dir), models, "y", LABEL_NAMES, 1, CAPTURED)
    pivot = pivot_log(rounded(log, "Metric_value"), ["by_quantity", "by_price"])
    return pivot.withColumns({c: F.round(c, 5) for c in ("by_quantity", "by_price")})


@query(f"WITH {SCORED} {_metrics_sql('by_price')}")
def metric_log_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = f"{shared_folder(spark)}/metric-log-{uuid.uuid4().hex}"
    append_log(quantity_scores(spark, sf_dir, "by_price"), location)
    return rounded(read_log(spark, location, METRIC_LOG), "Metric_value")


# Cut-offs


def _cutoffs_sql(score: str, over: str = ">") -> str:
    return f"""cutoffs AS (SELECT i / 100 AS cut, tp / (tp + fn) AS sensitivity, tn / (tn + fp) AS specificity,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS "precision", (tp + tn) / (tp + tn + fp + fn) AS accuracy
  FROM (SELECT CAST(i AS DOUBLE) AS i, CAST(count(*) FILTER (y = 1 AND up) AS DOUBLE) AS tp,
      CAST(count(*) FILTER (y = 0 AND up) AS DOUBLE) AS fp, CAST(count(*) FILTER (y = 1 AND NOT up) AS DOUBLE) AS fn,
      CAST(count(*) FILTER (y = 0 AND NOT up) AS DOUBLE) AS tn
    FROM (SELECT i, y, {score} {over} CASE i WHEN 100 THEN 1.0::DOUBLE ELSE CAST(i AS DOUBLE) * 0.01::DOUBLE END AS up
          FROM scored, range(101) AS steps(i)) GROUP BY i))"""


_CUTOFF_ROWS = """SELECT cut AS "Cut-Off", round(sensitivity, 6) AS "Sensitivity", round(specificity, 6) AS "Specificity",
  round("precision", 6) AS "precision", round(accuracy, 6) AS "Accuracy" FROM cutoffs"""


@query(f"WITH {SCORED}, {_cutoffs_sql('by_price')} {_CUTOFF_ROWS}")
def cutoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = cutoff_table(scored_lines(spark, sf_dir), "y", "by_price")
    return rounded(cuts, "Sensitivity", "Specificity", "precision", "Accuracy")


@query(f"WITH {SCORED}, {_cutoffs_sql('by_quantity', '>=')} {_CUTOFF_ROWS}")
def cutoff_scores_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = cutoff_table(scored_lines(spark, sf_dir), "y", "by_quantity", inclusive=True)
    return rounded(cuts, "Sensitivity", "Specificity", "precision", "Accuracy")


_CHOICE = """SELECT 'by_quantity' AS "Model_name", 'precision' AS selected_metric, 0.3334::DOUBLE AS "precision",
  round(sensitivity, 6) AS recall, cut AS "cut-off", round("precision", 6) AS achieved
FROM cutoffs WHERE "precision" >= 0.3334 ORDER BY sensitivity DESC, cut DESC LIMIT 1"""


def precision_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = cutoff_table(scored_lines(spark, sf_dir), "y", "by_quantity")
    return select_cutoff(cuts, "by_quantity", "precision", 0.3334)


@query(f"WITH {SCORED}, {_cutoffs_sql('by_quantity')} {_CHOICE}")
def choose_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(precision_choice(spark, sf_dir), "recall", "achieved")


@query(
    f"""WITH {SCORED}, {_cutoffs_sql('by_quantity')}
SELECT 'by_quantity' AS "Model_name", 'Sensitivity' AS selected_metric, round("precision", 6) AS "precision",
  0.3::DOUBLE AS recall, cut AS "cut-off", round(sensitivity, 6) AS achieved
FROM cutoffs WHERE sensitivity >= 0.3 AND "precision" IS NOT NULL ORDER BY "precision" DESC, cut DESC LIMIT 1"""
)
def choose_cutoff_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = cutoff_table(scored_lines(spark, sf_dir), "y", "by_quantity")
    return rounded(select_cutoff(cuts, "by_quantity", "Sensitivity", 0.3), "precision", "achieved")


@query(
    f"""WITH {SCORED}, {_cutoffs_sql('by_quantity')}
SELECT "Model_name", selected_metric, "precision", recall, "cut-off" FROM ({_CHOICE})"""
)
def threshold_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = f"{shared_folder(spark)}/threshold-{uuid.uuid4().hex}"
    write_threshold(precision_choice(spark, sf_dir), location)
    return rounded(read_threshold(spark, location), "recall")


# Drift


_SHARES = """shares AS (
  SELECT feature, value, a / sum(a) OVER (PARTITION BY feature) AS p, b / sum(b) OVER (PARTITION BY feature) AS q
  FROM (SELECT feature, value, CAST(count(*) FILTER (NOT new) AS DOUBLE) AS a,
          CAST(count(*) FILTER (new) AS DOUBLE) AS b
    FROM (SELECT 'o_orderpriority' AS feature, o_orderpriority AS value, o_orderdate >= '1998-01-01' AS new FROM orders
      UNION ALL SELECT 'o_orderstatus', o_orderstatus, o_orderdate >= '1998-01-01' FROM orders
      UNION ALL SELECT 'is_f', CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END, o_orderdate >= '1998-01-01'
        FROM orders) GROUP BY ALL))"""
_JS = """SELECT feature, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
  + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS js FROM shares GROUP BY feature"""
DRIFT_CATEGORIES = ["o_orderpriority", "o_orderstatus"]


@query(f"WITH {_SHARES} SELECT feature, value, round(p, 6) AS p, round(q, 6) AS q FROM shares WHERE feature <> 'is_f'")
def category_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = old_and_new_orders(spark, sf_dir)
    return rounded(category_distribution(old, new, DRIFT_CATEGORIES), "p", "q")


@query(f"WITH {_SHARES} SELECT feature, round(js, 9) AS js_divergence FROM ({_JS}) WHERE feature <> 'is_f'")
def js_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = old_and_new_orders(spark, sf_dir)
    scores = js_divergence(old, new, DRIFT_CATEGORIES)
    return scores.withColumn("js_divergence", F.round("js_divergence", 9))


@query(
    f"""WITH {_SHARES} SELECT feature, round(sum(CASE WHEN p > 0 THEN p * log2(p / q) ELSE 0 END), 9)
  AS kl_divergence FROM shares WHERE feature <> 'is_f' GROUP BY feature"""
)
def kl_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = old_and_new_orders(spark, sf_dir)
    scores = kl_divergence(old, new, DRIFT_CATEGORIES)
    return scores.withColumn("kl_divergence", F.round("kl_divergence", 9))


def _ks_sql(pairs: str) -> str:
    """`pairs` gives rows (feature, x, b): the value and whether it is on the second side."""
    return f"""ks AS (
  SELECT feature, d, n1, n2, CASE WHEN t < 0.2 THEN 1 ELSE least(1, greatest(0, (SELECT
      sum(CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END * exp(-2.0 * k * k * t * t)) FROM range(1, 101) AS ks(k)))) END AS p
  FROM (SELECT *, sqrt(m) * d + 1 / (6 * sqrt(m)) + (sqrt(m) * d - 1) / (4 * m) AS t
    FROM (SELECT *, CAST(round(n1 * 1.0 * n2 / (n1 + n2)) AS DOUBLE) AS m
      FROM (SELECT feature, max(abs(CAST(ca AS DOUBLE) / na - CAST(cb AS DOUBLE) / nb)) AS d,
          CAST(max(na) AS BIGINT) AS n1, CAST(max(nb) AS BIGINT) AS n2
        FROM (SELECT feature, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER f AS na, sum(b) OVER f AS nb
          FROM (SELECT feature, x, count(*) FILTER (NOT b) AS a, count(*) FILTER (b) AS b
            FROM ({pairs}) GROUP BY feature, x)
          WINDOW w AS (PARTITION BY feature ORDER BY x), f AS (PARTITION BY feature))
        GROUP BY feature))))"""


_LINE_PAIRS = """SELECT 'l_extendedprice' AS feature, l_extendedprice AS x, l_linestatus = 'O' AS b FROM lineitem
  UNION ALL SELECT 'l_quantity', l_quantity, l_linestatus = 'O' FROM lineitem"""


@query(
    f"""WITH {_ks_sql(_LINE_PAIRS)} SELECT feature, round(d, 6) AS distance, round(p, 6) AS p_value,
  n1 AS n_left, n2 AS n_right FROM ks"""
)
def ks_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_linestatus", "l_extendedprice", "l_quantity")
    left, right = lines.filter(F.col("l_linestatus") != "O"), lines.filter(F.col("l_linestatus") == "O")
    return rounded(ks_two_sample(left, right, ["l_extendedprice", "l_quantity"]), "distance", "p_value")


_ORDER_PAIRS = """SELECT 'o_totalprice' AS feature, o_totalprice AS x, o_orderdate >= '1998-01-01' AS b FROM orders
  UNION ALL SELECT 'o_custkey', CAST(o_custkey AS DOUBLE), o_orderdate >= '1998-01-01' FROM orders"""


@query(
    f"""WITH {_SHARES}, {_ks_sql(_ORDER_PAIRS)}
SELECT 1 AS "Model_version", 'Categorical' AS "Label_category", feature AS "Feature_name",
  'JS_Divergence' AS "Metric_name", round(js, 3) AS "Metric_value", DATE '{CAPTURED}' AS capture_date FROM ({_JS})
UNION ALL SELECT 1, 'Continous', feature, 'KS_Divergence - Pvalue', round(p, 3), DATE '{CAPTURED}' FROM ks"""
)
def drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = old_and_new_orders(spark, sf_dir)
    return drift_report(old, new, DRIFT_CATEGORIES, ["o_totalprice", "o_custkey"], "is_f", 1, CAPTURED)


# Feature scores


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(
        spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return lines.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_linestatus") == "O").cast("int").alias("is_open"),
        (F.col("l_linenumber") < 4).cast("int").alias("is_early"),
        F.col("l_quantity"),
        F.col("l_extendedprice"),
    )


_CHI = """lines AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
    CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_open, CASE WHEN l_linenumber < 4 THEN 1 ELSE 0 END AS is_early,
    l_quantity, l_extendedprice FROM lineitem),
  cells AS (SELECT feature, v, y, CAST(count(*) AS DOUBLE) AS o FROM (
    SELECT 'is_open' AS feature, is_open AS v, y FROM lines
    UNION ALL SELECT 'is_early', is_early, y FROM lines) GROUP BY ALL),
  expected AS (SELECT feature, o, sum(o) OVER (PARTITION BY feature, v) * sum(o) OVER (PARTITION BY feature, y)
      / sum(o) OVER (PARTITION BY feature) AS e FROM cells),
  chi AS (SELECT feature, sum((o - e) * (o - e) / e) AS statistic FROM expected GROUP BY feature)"""
# The tail of a chi-square with one degree of freedom, by Simpson's rule on the normal density.
_CHI_P = """(SELECT 1 - sqrt(2 / pi()) * sqrt(statistic) / 2000 / 3 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1
    THEN 4 ELSE 2 END * exp(-statistic * i * i / 2000.0 / 2000.0 / 2)) FROM range(2001) AS s(i))"""


@query(
    f"""WITH {_CHI} SELECT feature, round({_CHI_P}, 6) AS p_value, 1::BIGINT AS dof, round(statistic, 6) AS statistic FROM chi"""
)
def chi_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = chi_square_scores(labelled_lines(spark, sf_dir), ["is_open", "is_early"], "y")
    return rounded(scores, "p_value", "statistic")


_WIDE_CELLS = """cells AS (SELECT l_partkey AS v, l_suppkey AS y, CAST(count(*) AS DOUBLE) AS o FROM lineitem GROUP BY ALL),
  of_value AS (SELECT v, sum(o) AS n FROM cells GROUP BY v), of_label AS (SELECT y, sum(o) AS n FROM cells GROUP BY y),
  size AS (SELECT sum(o) AS n FROM cells),
  wide AS (SELECT (SELECT sum(o * o / (a.n * b.n)) FROM cells JOIN of_value a USING (v) JOIN of_label b USING (y)) * size.n - size.n AS statistic,
    ((SELECT count(*) FROM of_value) - 1) * ((SELECT count(*) FROM of_label) - 1) AS dof FROM size)"""
# Far from few degrees the cube root of a chi-square over its freedom is nearly normal (Wilson and Hilferty): right to 1e-4.
_WIDE_P = """CASE WHEN z > 0 THEN tail ELSE 1 - tail END"""


@query(
    f"""WITH {_WIDE_CELLS}, z AS (SELECT *, (cbrt(statistic / dof) - (1 - 2.0 / (9.0 * dof))) / sqrt(2.0 / (9.0 * dof)) AS z FROM wide),
  t AS (SELECT *, 0.5 - abs(z) / 2000 / 3 / sqrt(2 * pi()) * (SELECT sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * exp(-z * z * i * i / 2000.0 / 2000.0 / 2)) FROM range(2001) AS s(i)) AS tail FROM z)
SELECT 'l_partkey' AS feature, dof::BIGINT AS dof, round(statistic, 3) AS statistic, round({_WIDE_P}, 3) AS p_value FROM t"""
)
def chi_square_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two key columns: at sf0.01 some 200,000 degrees of freedom."""
    lines = table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey")
    scores = chi_square_scores(lines, ["l_partkey"], "l_suppkey")
    return scores.withColumns({"statistic": F.round("statistic", 3), "p_value": F.round("p_value", 3)})


_F = """f AS (SELECT feature, n, r2 / (1 - r2) * (n - 2) AS f_value FROM (
    SELECT 'l_quantity' AS feature, count(*) AS n,
      covar_pop(l_quantity, y) * covar_pop(l_quantity, y) / var_pop(l_quantity) / var_pop(y) AS r2 FROM lines
    UNION ALL SELECT 'l_extendedprice', count(*),
      covar_pop(l_extendedprice, y) * covar_pop(l_extendedprice, y) / var_pop(l_extendedprice) / var_pop(y) FROM lines))"""
# The two-sided t tail, by Simpson's rule on the t density.
_F_P = """(SELECT 1 - 2 * exp(lgamma((n - 1) / 2.0) - lgamma((n - 2) / 2.0)) / sqrt((n - 2) * pi())
    * sqrt(f_value) / 2000 / 3 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * pow(1 + f_value * i * i / 2000.0 / 2000.0 / (n - 2), -(n - 1) / 2.0)) FROM range(2001) AS s(i))"""


@query(
    f"""WITH {_CHI}, {_F} SELECT feature, n, round(f_value, 5) AS f_value, round({_F_P}, 6) AS p_value FROM f"""
)
def f_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = f_test_scores(labelled_lines(spark, sf_dir), ["l_quantity", "l_extendedprice"], "y")
    return scores.withColumns({"f_value": F.round("f_value", 5), "p_value": F.round("p_value", 6)})


@query(
    f"""WITH {_CHI}, {_F}
SELECT 1 AS "Model_version", 'Categorical' AS "Label_category", feature AS "Feature_name",
  'Chi-Square test - pValue' AS "Metric_name", round({_CHI_P}, 3) AS "Metric_value", DATE '{CAPTURED}' AS capture_date FROM chi
UNION ALL SELECT 1, 'Continous', feature, 'Anova test - pValue', round({_F_P}, 3), DATE '{CAPTURED}' FROM f"""
)
def feature_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = FeatureScores(
        categoryCols=["is_open", "is_early"], numberCols=["l_quantity", "l_extendedprice"], labelCol="y",
        modelVersion=1, captureDate=CAPTURED,
    )
    return stage.transform(labelled_lines(spark, sf_dir))


_METRIC_ROWS = f"""SELECT 'metric' AS log, "Label_category" AS category, classifier AS of, "Metric_name" AS metric, "Metric_value" AS value
FROM ({_metrics_sql('by_price')})"""


@query(
    f"""WITH {SCORED}, {_SHARES}, {_ks_sql(_ORDER_PAIRS)}, {_CHI}, {_F}
{_METRIC_ROWS}
UNION ALL SELECT 'drift', 'Categorical', feature, 'JS_Divergence', round(js, 3) FROM ({_JS})
UNION ALL SELECT 'drift', 'Continous', feature, 'KS_Divergence - Pvalue', round(p, 3) FROM ks
UNION ALL SELECT 'feature', 'Categorical', feature, 'Chi-Square test - pValue', round({_CHI_P}, 3) FROM chi
UNION ALL SELECT 'feature', 'Continous', feature, 'Anova test - pValue', round({_F_P}, 3) FROM f"""
)
def logs_written_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three logs, each written twice by the same run, as a retried job would, and read once."""
    logs = {
        "metric": (quantity_scores(spark, sf_dir, "by_price"), METRIC_LOG, "classifier"),
        "drift": (drift_log(spark, sf_dir), FEATURE_LOG, "Feature_name"),
        "feature": (feature_log(spark, sf_dir), FEATURE_LOG, "Feature_name"),
    }
    read = []
    for name, (log, schema, of) in logs.items():
        location = f"{shared_folder(spark)}/{name}-log-{uuid.uuid4().hex}"
        for _ in range(2):
            append_log(log, location, run_id="run-1")
        rows = read_log(spark, location, schema)
        read.append(rows.select(
            F.lit(name).alias("log"), F.col("Label_category").alias("category"), F.col(of).alias("of"),
            F.col("Metric_name").alias("metric"), F.round("Metric_value", 6).alias("value"),
        ))
    return union_logs(read)


# Training


#: The logistic grid is whole: 45 candidates on two folds and one fit on all rows. README says what the others take whole.
SURVEY_GRIDS = {
    "GBTClassifier": {"stepSize": [0.1], "maxDepth": [2], "maxIter": [3]},
    "RandomForestClassifier": {"numTrees": [5], "maxDepth": [3]},
    "LogisticRegression": GRIDS["LogisticRegression"],
}
SURVEY_LABEL = "HeartDisease_Yes"
#: A stump: boosting that stops after one split, whose best feature SQL can find.
STUMP = {"GBTClassifier": {"maxIter": [1], "maxDepth": [1]}}
STUMP_FEATURES = [*[f"{c}_{yes}" for c, (_, yes, _no) in _SURVEY_ANSWERS.items() if c != "HeartDisease"], "Race_Asian", "Race_White"]


def train_config(spark: SparkSession, grids: dict) -> TrainConfig:
    """The test tables are one file each, so the rows are spread over the cores first."""
    return TrainConfig(grids=grids, partitions=spark.sparkContext.defaultParallelism)


def survey_sides(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    rows = survey(spark, sf_dir)
    keyed = rows.withColumn("row_key", F.concat_ws("-", "l_orderkey", "l_linenumber")).drop("l_orderkey", "l_linenumber")
    features = survey_recipe(assemble=False).fit(keyed).transform(keyed)
    if names:
        features = features.select("row_key", SURVEY_LABEL, *names)
    # Split first: the draw is a filter on the scan, and does not sink below the assembler.
    sides = stratified_split(features, SURVEY_LABEL, key_columns=["row_key"])
    assembly = FeatureAssembly(excludeCols=[SURVEY_LABEL, "row_key"]).fit(features)
    return tuple(assembly.transform(side) for side in sides)


def survey_experiment(
    spark: SparkSession, sides: tuple[DataFrame, DataFrame], grids: dict, save_to: str | None = None
) -> Experiment:
    return run_experiment(
        list(grids), *sides, SURVEY_LABEL, "features", LABEL_NAMES, train_config(spark, grids), save_to,
        capture_date=CAPTURED, key_columns=["row_key"],
    )


@query()
def experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_experiment(spark, survey_sides(spark, sf_dir), SURVEY_GRIDS).train_results


@query()
def tuned_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cut-off of the best of 45 logistic candidates, which the ledger tells."""
    sides = survey_sides(spark, sf_dir)
    location = f"{shared_folder(spark)}/models-{uuid.uuid4().hex}"
    survey_experiment(spark, sides, {"LogisticRegression": GRIDS["LogisticRegression"]}, location)
    return tune_cutoff("LogisticRegression", location, sides[1], SURVEY_LABEL, "Sensitivity", 0.5)


def saved_stump(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the saved stump, and the test side."""
    sides = survey_sides(spark, sf_dir, STUMP_FEATURES)
    location = f"{shared_folder(spark)}/models-{uuid.uuid4().hex}"
    survey_experiment(spark, sides, STUMP, location)
    return model_rows(spark, location, "GBTClassifier"), sides[1]


_STUMP = (
    f"WITH survey AS ({_SURVEY} FROM lineitem), told AS (SELECT concat(l_orderkey, '-', l_linenumber) AS row_key, "
    + ", ".join(f"CASE WHEN {c} = '{yes}' THEN 1 ELSE 0 END AS {c}_{yes}" for c, (_, yes, _no) in _SURVEY_ANSWERS.items())
    + ", CASE WHEN Race = 'Asian' THEN 1 ELSE 0 END AS Race_Asian, CASE WHEN Race = 'White' THEN 1 ELSE 0 END AS Race_White FROM survey),"
    + """
  sided AS (SELECT *, CAST(concat('0x', substr(md5(concat('42', chr(1), row_key)), 1, 8)) AS BIGINT) / 4294967296.0 < 0.7
    AS train FROM told),
  tried AS ("""
    + " UNION ALL ".join(
        f"SELECT {i} AS nth, '{f}' AS feature, {f} AS x, 2.0::DOUBLE * HeartDisease_Yes - 1 AS y FROM sided WHERE train"
        for i, f in enumerate(STUMP_FEATURES)
    )
    + """),
  halves AS (SELECT nth, feature, count(*) AS n, avg(y) AS m, count(*) FILTER (x = 0) AS n_left, count(*) FILTER (x = 1) AS n_right,
      avg(y) FILTER (x = 0) AS m_left, avg(y) FILTER (x = 1) AS m_right FROM tried GROUP BY nth, feature),
  stump AS (SELECT * FROM halves ORDER BY n_left * m_left * m_left + n_right * m_right * m_right DESC, nth LIMIT 1)"""
)
_STUMP_SCORE = " ".join(f"WHEN '{f}' THEN {f}" for f in STUMP_FEATURES)


@query(
    f"""{_STUMP} SELECT 0 AS node, feature, 0.5::DOUBLE AS threshold, round(m, 6) AS prediction, n FROM stump
UNION ALL SELECT 1, NULL, NULL, round(m_left, 6), n_left FROM stump
UNION ALL SELECT 2, NULL, NULL, round(m_right, 6), n_right FROM stump"""
)
def saved_model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = saved_stump(spark, sf_dir)
    names = F.array(*map(F.lit, STUMP_FEATURES))
    feature = F.when(F.col("feature") >= 0, F.get(names, F.col("feature")))
    return rounded(rows.select("node", feature.alias("feature"), "threshold", "prediction", "n"), "prediction")


@query(
    f"""{_STUMP}, scored AS (SELECT HeartDisease_Yes AS y, 1 / (1 + exp(-2 * CASE CASE feature {_STUMP_SCORE} END
      WHEN 0 THEN m_left ELSE m_right END)) AS p FROM sided, stump WHERE NOT train),
{_cutoffs_sql('p')} {_CUTOFF_ROWS}"""
)
def saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, test = saved_stump(spark, sf_dir)
    cuts = cutoff_table(score_by_rows(test, rows, "GBTClassifier"), SURVEY_LABEL, "prob_raw")
    return rounded(cuts, "Sensitivity", "Specificity", "precision", "Accuracy")
