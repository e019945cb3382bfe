"""Penalised logistic regression on tables."""

from __future__ import annotations

from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inplay.functions import display_name, sign_label
from inplay.operators.features import TablePreprocessor, TablePreprocessorModel, _TableParams
from inplay.schema import LABEL_COLUMN


class TableClassifier(Estimator, _TableParams, DefaultParamsReadable, DefaultParamsWritable):
    """Preprocessing and a logistic regression with an L2 penalty, fitted on the same rows.

    Minimises half the squared norm of the coefficients plus ``strength`` times the summed log loss; the
    intercept is not penalised. Spark averages the loss, so its penalty is 1 / (strength * rows).
    """

    labelCol = Param(Params._dummy(), "labelCol", "boolean or 0/1 label", TypeConverters.toString)
    strength = Param(Params._dummy(), "strength", "inverse penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iteration limit", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "convergence tolerance", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, references=None, labelCol=None,
                 strength=None, maxIter=None, tol=None, outputCol=None):
        super().__init__()
        defaults = TablePreprocessor()
        self._setDefault(numericCols=[], categoricalCols=[], references=defaults.getOrDefault("references"),
                         outputCol="features", labelCol=LABEL_COLUMN, strength=1.0, maxIter=1000, tol=1e-7)
        self._set(**self._input_kwargs)

    def preprocessor(self) -> TablePreprocessor:
        names = ("numericCols", "categoricalCols", "references", "outputCol")
        return TablePreprocessor(**{n: self.getOrDefault(n) for n in names})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return self.fit_prepared(dataset, self.preprocessor().fit(dataset))

    def fit_prepared(self, dataset: DataFrame, prepared: TablePreprocessorModel) -> PipelineModel:
        """Fit on rows whose preprocessing is already learned from the same rows."""
        regression = LogisticRegression(
            featuresCol=self.getOrDefault("outputCol"), labelCol="__label",
            regParam=1.0 / (self.getOrDefault("strength") * prepared.n_rows), elasticNetParam=0.0,
            standardization=False, maxIter=self.getOrDefault("maxIter"), tol=self.getOrDefault("tol"))
        labelled = prepared.transform(dataset).select(
            self.getOrDefault("outputCol"), F.col(self.getOrDefault("labelCol")).cast("double").alias("__label"))
        return PipelineModel([prepared, regression.fit(labelled)])


def score_column(model: PipelineModel) -> Column:
    """Probability of the positive class as one native expression, without building vectors."""
    prepared, regression = model.stages
    terms = [F.lit(float(w)) * x for w, x in zip(regression.coefficients, prepared.encoded().values())]
    margin = reduce(lambda a, b: a + b, terms, F.lit(float(regression.intercept)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def score(model: PipelineModel, rows: DataFrame, name: str = "p") -> DataFrame:
    return rows.withColumn(name, score_column(model))


def score_by_transform(model: PipelineModel, rows: DataFrame, name: str = "p") -> DataFrame:
    """The same probability through the fitted stages."""
    out = model.transform(rows).withColumn(name, vector_to_array("probability")[1])
    return out.select(*rows.columns, name)


def coefficients(model: PipelineModel) -> DataFrame:
    """Feature, coefficient and odds ratio; sort at output."""
    prepared, regression = model.stages
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(float(w)).alias("coefficient"))
                     for n, w in zip(prepared.feature_names, regression.coefficients)])
    frame = SparkSession.active().range(1).select(F.inline(rows))
    return frame.withColumn("odds_ratio", F.exp("coefficient"))


def coefficient_impact(model: PipelineModel) -> DataFrame:
    """Coefficients under display names, with the direction of their effect."""
    return coefficients(model).select(
        display_name("feature").alias("predictor"), "coefficient", "odds_ratio",
        sign_label("coefficient").alias("impact"))
