"""Scoring by the rows of a saved model: a plan of built-in expressions, without the model's own class.

The model is a table (`sources.models.model_rows`): it can be looked at, joined with feature names, compared between versions,
and read by an engine that does not know the library. The plan takes it in as one value of a scalar subquery, which Spark
evaluates once; it is as large as the model and does not grow with the rows scored.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the deepest tree that training makes.
MOST_DEPTH = 30


def logistic(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def score_by_coefficients(df: DataFrame, rows: DataFrame, features: str = "features") -> DataFrame:
    """Adds `prob_raw` from (feature, value) rows of a logistic model. NULL features give NULL."""
    slots = F.array_sort(F.collect_list(F.struct("feature", "value")))
    model = rows.agg(F.transform(slots, lambda s: s["value"]).alias("values")).scalar()
    return (
        df.withColumn("__model", model)
        .withColumn(
            "prob_raw",
            logistic(
                F.aggregate(
                    F.zip_with(F.concat(F.array(F.lit(1.0)), vector_to_array(features)), "__model", lambda x, c: x * c),
                    F.lit(0.0),
                    lambda total, term: total + term,
                )
            ),
        )
        .drop("__model")
    )


def _leaf(nodes: Column, values: Column) -> Column:
    """The leaf that a row ends in: from node to node, at most MOST_DEPTH steps."""

    def step(at: Column, _: Column) -> Column:
        node = F.get(nodes, at)
        x = F.get(values, node["feature"])
        left = F.when(node["categories"].isNull(), x <= node["threshold"]).otherwise(F.array_contains(node["categories"], x))
        return F.when(node["left"] < 0, at).when(left, node["left"]).otherwise(node["right"])

    return F.get(nodes, F.aggregate(F.sequence(F.lit(1), F.lit(MOST_DEPTH)), F.lit(0), step))


def score_by_trees(df: DataFrame, rows: DataFrame, features: str = "features", boosted: bool = False) -> DataFrame:
    """Adds `prob_raw` from `tree_rows`: the mean share of class 1 in the leaves or, where boosted, the logistic of twice their weighted sum."""
    columns = ["node", "prediction", "positive", "left", "right", "feature", "threshold", "categories"]
    trees = rows.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("nodes"))
    model = trees.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees")).scalar()
    values = F.col("__values")
    votes = F.transform("__model", lambda t: t["weight"] * _leaf(t["nodes"], values)["prediction" if boosted else "positive"])
    total = F.aggregate(votes, F.lit(0.0), lambda a, v: a + v)
    weights = F.aggregate("__model", F.lit(0.0), lambda a, t: a + t["weight"])
    score = logistic(2.0 * total) if boosted else total / weights
    ready = df.withColumns({"__model": model, "__values": vector_to_array(features)})
    return ready.withColumn("prob_raw", score).drop("__model", "__values")


def score_by_rows(df: DataFrame, rows: DataFrame, name: str, features: str = "features") -> DataFrame:
    """Adds `prob_raw`, as the model of this name would: within rounding, the probability that `infer` adds."""
    if name == "LogisticRegression":
        return score_by_coefficients(df, rows, features)
    return score_by_trees(df, rows, features, boosted=name == "GBTClassifier")
