"""Fitting, scoring and comparing models on an extract."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from inplay.functions import round_half_even
from inplay.operators import checks, metrics
from inplay.operators.metrics import METRICS, MODEL_A, MODEL_B
from inplay.operators.model import TableClassifier, score, score_column
from inplay.operators.split import complete_cases, time_split
from inplay.schema import (
    BASELINE_WINDOW, CATEGORICAL, CONTACT_NUMERIC, DATE_COLUMN, LABEL_COLUMN, MODEL_B_FEATURES, REFERENCE_LEVELS,
    SWING_NUMERIC, THRESHOLD, TRACKING_WINDOW, Window,
)


@dataclass(frozen=True)
class Fitted:
    """A fitted model, the lazily scored test rows, and the lazy metrics of these."""

    model: PipelineModel
    scored: DataFrame
    metrics: DataFrame


@contextmanager
def _kept(df: DataFrame):
    """Keep training columns for the passes of a fit; blocks lost with an executor are computed again."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def _single(extract: DataFrame, window: Window, numeric: list[str], categorical: list[str]) -> Fitted:
    train, test = time_split(extract, window)
    checks.require_feature_schema(train, test, numeric, categorical)
    estimator = TableClassifier(numericCols=numeric, categoricalCols=categorical)
    with _kept(train.select(*numeric, *categorical, LABEL_COLUMN)) as rows:
        model = estimator.fit(rows)
    checks.require_rows(test, "test split")
    scored = score(model, test)
    result = metrics.evaluation(scored, "p", LABEL_COLUMN, THRESHOLD, strict_decision=True)
    return Fitted(model, scored, result)


def baseline_experiment(extract: DataFrame) -> Fitted:
    """Contact features, all seasons before the last for training; missing values are imputed."""
    return _single(extract, BASELINE_WINDOW, CONTACT_NUMERIC, CATEGORICAL)


def tracking_experiment(extract: DataFrame) -> Fitted:
    """Contact and swing features from the first day of swing tracking; missing values are imputed."""
    return _single(extract, TRACKING_WINDOW, CONTACT_NUMERIC + SWING_NUMERIC, CATEGORICAL)


def rounded(result: DataFrame, digits: int = 3) -> DataFrame:
    """Metrics as single-model reports print them: rounded half to even."""
    return result.select(*[round_half_even(F.col(c), digits).alias(c) if c in METRICS else F.col(c)
                           for c in result.columns])


@dataclass(frozen=True)
class Comparison:
    model_a: PipelineModel
    model_b: PipelineModel
    scored: DataFrame
    table: DataFrame


def compare(extract: DataFrame, window: Window = TRACKING_WINDOW, threshold: float = THRESHOLD) -> Comparison:
    """Contact features (A) against contact and swing features (B), on the same complete rows.

    The preprocessing is learned once, for the columns of B, which contain those of A. Both models are
    fitted on one kept frame, and one scan of the test rows scores and evaluates both, so neither can
    see rows the other does not.
    """
    checks.require_columns(extract.columns, [*MODEL_B_FEATURES, LABEL_COLUMN, DATE_COLUMN])
    train, test = time_split(extract, window)
    numeric = CONTACT_NUMERIC + SWING_NUMERIC
    checks.require_feature_schema(train, test, numeric, CATEGORICAL)
    a = TableClassifier(numericCols=CONTACT_NUMERIC, categoricalCols=CATEGORICAL, references=REFERENCE_LEVELS)
    b = TableClassifier(numericCols=numeric, categoricalCols=CATEGORICAL, references=REFERENCE_LEVELS)
    with _kept(complete_cases(train).select(*MODEL_B_FEATURES, LABEL_COLUMN)) as rows:
        prepared = b.preprocessor().fit(rows)
        model_a = a.fit_prepared(rows, prepared.restricted(CONTACT_NUMERIC, CATEGORICAL))
        model_b = b.fit_prepared(rows, prepared)
    complete_test = complete_cases(test)
    checks.require_rows(complete_test, "complete test split")
    scored = complete_test.select(
        "*", score_column(model_a).alias("p_a"), score_column(model_b).alias("p_b"))
    both = stack_scores(scored)
    table = metrics.with_difference(
        metrics.evaluation(both, "p", LABEL_COLUMN, threshold, by=["model"]))
    return Comparison(model_a, model_b, scored, table)


def stack_scores(scored: DataFrame, a: str = "p_a", b: str = "p_b", label: str = LABEL_COLUMN) -> DataFrame:
    """Two score columns as rows ``(label, model, p)``, from one scan."""
    entries = F.array(F.struct(F.lit(MODEL_A).alias("model"), F.col(a).alias("p")),
                      F.struct(F.lit(MODEL_B).alias("model"), F.col(b).alias("p")))
    return scored.select(label, F.explode(entries).alias("s")).select(label, "s.model", "s.p")
