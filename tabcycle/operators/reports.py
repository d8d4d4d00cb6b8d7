"""Reports as last stages of a pipeline: they replace the rows by a log."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tabcycle.plans.feature_scores import feature_report
from tabcycle.plans.metrics import model_scores


class _Report(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    modelVersion = Param(Params._dummy(), "modelVersion", "version written to the log", TypeConverters.toInt)
    captureDate = Param(Params._dummy(), "captureDate", "date written to the log", TypeConverters.toString)

    def _date(self) -> str | None:
        return self.getOrDefault("captureDate") if self.isSet("captureDate") else None


class ModelScores(_Report):
    """Scored rows in, metric log out."""

    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "positive-class probability", TypeConverters.toString)
    labelNames = Param(Params._dummy(), "labelNames", "[label, name] pairs")
    modelName = Param(Params._dummy(), "modelName", "classifier written to the log", TypeConverters.toString)

    @keyword_only
    def __init__(
        self,
        *,
        predictionCol: str | None = None,
        labelCol: str | None = None,
        labelNames: dict | list | None = None,
        scoreCol: str | None = None,
        modelVersion: int | None = None,
        modelName: str | None = None,
        captureDate: str | None = None,
    ):
        super().__init__()
        given = dict(self._input_kwargs)
        if isinstance(labelNames, dict):
            given["labelNames"] = [[float(k), v] for k, v in labelNames.items()]
        self._set(**given)

    def _transform(self, df: DataFrame) -> DataFrame:
        return model_scores(
            df,
            prediction=self.getOrDefault("predictionCol"),
            label=self.getOrDefault("labelCol"),
            label_names=dict(map(tuple, self.getOrDefault("labelNames"))),
            score=self.getOrDefault("scoreCol"),
            model_version=self.getOrDefault("modelVersion"),
            model_name=self.getOrDefault("modelName"),
            capture_date=self._date(),
        )


class FeatureScores(_Report):
    """Feature rows in, feature-score log out."""

    categoryCols = Param(Params._dummy(), "categoryCols", "indicator columns", TypeConverters.toListString)
    numberCols = Param(Params._dummy(), "numberCols", "continuous columns", TypeConverters.toListString)

    @keyword_only
    def __init__(
        self,
        *,
        categoryCols: list[str] | None = None,
        numberCols: list[str] | None = None,
        labelCol: str | None = None,
        modelVersion: int | None = None,
        captureDate: str | None = None,
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return feature_report(
            df,
            categories=self.getOrDefault("categoryCols"),
            numbers=self.getOrDefault("numberCols"),
            label=self.getOrDefault("labelCol"),
            model_version=self.getOrDefault("modelVersion"),
            capture_date=self._date(),
        )
