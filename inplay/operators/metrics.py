"""Threshold and ranking metrics of scored rows.

Rows are first reduced to one row per distinct score, which takes ties together and shrinks the data in
each task before any shuffle. Ranking metrics need totals over all higher scores; these come from
``running_totals`` over cells of the score, so no task sees all scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from inplay.functions import as_label, safe_ratio, threshold_label
from inplay.operators.prefix import running_totals
from inplay.schema import THRESHOLD

# Metric columns and their report names, in report order.
METRICS = {
    "observed_hit_rate": "Observed Hit Rate",
    "expected_hit_rate": "Expected Hit Rate",
    "predicted_hits_at_threshold": "Predicted Hits At Threshold",
    "accuracy": "Accuracy",
    "precision": "Precision",
    "recall": "Recall",
    "specificity": "Specificity",
    "f1": "F1",
    "roc_auc": "ROC AUC",
    "average_precision": "Average Precision",
}
# Row names of a comparison.
MODEL_A, MODEL_B, DIFFERENCE = "Model A", "Model B", "Metric Difference: B - A"

_FINE_BITS = 28
_COARSE_BITS = 14
# No positive double has a logarithm beyond it.
_LOG_SPAN = 745.0


def score_counts(scored: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = as_label(label).cast("bigint")
    return scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))


def _cells(top: float, bottom: float) -> list[Column]:
    """Coarse and fine cells of a score, ascending as the score falls.

    Half of the range of cells is linear in the score, half in its logarithm near either end, so scores that crowd
    at an end are spread too. A coarse cell has at most 2^14 fine ones, and there are at most 2^14 coarse cells, so
    no group of cell totals outgrows one task. A score outside the given span falls in an outer cell.
    """
    width = F.lit(top - bottom)
    above, below = (F.col("score") - F.lit(bottom)) / width, (F.lit(top) - F.col("score")) / width
    linear = F.greatest(F.lit(0.0), F.least(F.lit(1.0), below))
    tail = (F.when(above <= 0, _LOG_SPAN).when(below <= 0, -_LOG_SPAN)
            .when(above < 0.5, -F.log(2 * above)).otherwise(F.log(2 * below)))
    bounded = F.greatest(F.lit(-_LOG_SPAN), F.least(F.lit(_LOG_SPAN), tail))
    share = linear / 2 + (bounded + _LOG_SPAN) / (4 * _LOG_SPAN)
    fine = F.floor(share * (2**_FINE_BITS - 1)).cast("bigint")
    return [F.shiftright(fine, _COARSE_BITS), fine]


def cumulative_counts(scored: DataFrame, score: str = "p", label: str = "label", by: Sequence[str] = (),
                      span: tuple[float, float] = (0.0, 1.0), ahead: bool = False) -> DataFrame:
    """Per distinct score: its counts, the counts at or above it (``tps``, ``fps``) and the totals.

    With ``ahead`` also the counts of the next lower score.
    """
    counts = score_counts(scored, score, label, by)
    following = {"next_pos": F.col("pos"), "next_neg": F.col("neg")} if ahead else None
    return running_totals(counts, {"tps": F.col("pos"), "fps": F.col("neg")}, _cells(span[1], span[0]),
                          [-F.col("score")], by, grand_suffix="_all", ahead=following)


def evaluation(scored: DataFrame, score: str = "p", label: str = "label", threshold: float = THRESHOLD,
               by: Sequence[str] = (), strict_decision: bool = False,
               span: tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """The ten metrics, one row per group of ``by``, from one scan.

    The predicted rate always counts ``p >= threshold``. The confusion metrics use the same rule, or
    ``p > threshold`` with ``strict_decision``, which is how a fitted model decides on its own.
    A ratio with a zero denominator is 0; ROC AUC is null when one class is missing.
    """
    c = cumulative_counts(scored, score, label, by, span)
    positive = threshold_label("score", threshold, strict_decision) == 1
    inclusive = threshold_label("score", threshold) == 1
    both = F.col("pos") + F.col("neg")
    tps, pos, neg = F.col("tps").cast("double"), F.col("pos"), F.col("neg")
    sums = c.groupBy(*by).agg(
        F.sum("pos").alias("p_all"), F.sum("neg").alias("n_all"),
        F.sum(F.when(positive, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(positive, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(inclusive, both).otherwise(0)).alias("predicted"),
        F.sum(F.col("score") * both).alias("score_sum"),
        F.sum(neg * (tps - pos / F.lit(2.0))).alias("area"),
        F.sum(pos * safe_ratio(F.col("tps"), F.col("tps") + F.col("fps"))).alias("precision_sum"))
    tp, fp, p_all, n_all = (F.col(x) for x in ("tp", "fp", "p_all", "n_all"))
    everything = p_all + n_all
    tn = n_all - fp
    return sums.select(
        *by,
        safe_ratio(p_all, everything).alias("observed_hit_rate"),
        safe_ratio(F.col("score_sum"), everything).alias("expected_hit_rate"),
        safe_ratio(F.col("predicted"), everything).alias("predicted_hits_at_threshold"),
        safe_ratio(tp + tn, everything).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, p_all).alias("recall"),
        safe_ratio(tn, n_all).alias("specificity"),
        safe_ratio(2 * tp, tp + fp + p_all).alias("f1"),
        F.try_divide(F.col("area"), p_all.cast("double") * n_all.cast("double")).alias("roc_auc"),
        safe_ratio(F.col("precision_sum"), p_all).alias("average_precision"))


def roc_auc(scored: DataFrame, score: str = "p", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    return evaluation(scored, score, label, by=by).select(*by, "roc_auc")


def average_precision(scored: DataFrame, score: str = "p", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Step-wise area: each rise in recall counts at the precision reached there."""
    return evaluation(scored, score, label, by=by).select(*by, "average_precision")


def roc_curve(scored: DataFrame, score: str = "p", label: str = "label", by: Sequence[str] = (),
              drop_intermediate: bool = False, span: tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """Points ``(threshold, fpr, tpr)``, one per distinct score, and (0, 0) at an infinite threshold.

    With ``drop_intermediate`` a point is left out when the next score adds exactly the same counts, as
    the point then lies on the line between its neighbours. The points of the highest and lowest score
    always stay.
    """
    c = cumulative_counts(scored, score, label, by, span, ahead=drop_intermediate)
    first = (F.col("tps") == F.col("pos")) & (F.col("fps") == F.col("neg"))
    if drop_intermediate:
        repeats = F.col("next_pos").eqNullSafe(F.col("pos")) & F.col("next_neg").eqNullSafe(F.col("neg"))
        kept = first | ~repeats
    else:
        kept = F.lit(True)
    zero = F.lit(0).cast("bigint")
    origin = F.struct(F.lit(float("inf")).alias("threshold"), zero.alias("fps"), zero.alias("tps"))
    point = F.when(kept, F.struct(F.col("score").alias("threshold"), "fps", "tps"))
    points = c.select(*by, "tps_all", "fps_all", F.explode(F.array_compact(
        F.array(F.when(first, origin), point))).alias("pt"))
    return points.select(
        *by, "pt.threshold",
        F.try_divide(F.col("pt.fps").cast("double"), F.col("fps_all").cast("double")).alias("fpr"),
        F.try_divide(F.col("pt.tps").cast("double"), F.col("tps_all").cast("double")).alias("tpr"))


def confusion_matrix(scored: DataFrame, score: str = "p", label: str = "label", threshold: float = THRESHOLD,
                     by: Sequence[str] = (), strict_decision: bool = True) -> DataFrame:
    """Rows per actual and predicted class."""
    return scored.groupBy(*by, as_label(label).alias("actual"),
                          threshold_label(score, threshold, strict_decision).alias("predicted")).agg(
        F.count("*").alias("observations"))


def with_difference(metrics: DataFrame, a: str = MODEL_A, b: str = MODEL_B, name: str = DIFFERENCE) -> DataFrame:
    """Metric rows of two models and a third row with the differences b - a."""
    columns = [c for c in metrics.columns if c != "model"]
    sign = F.when(F.col("model") == b, 1.0).when(F.col("model") == a, -1.0)
    # Each row is emitted as itself and, signed, as a part of the difference.
    parts = metrics.select(F.explode(F.array(
        F.struct("model", *columns),
        F.struct(F.lit(name).alias("model"), *[(sign * F.col(c)).alias(c) for c in columns]))).alias("r"))
    return parts.select("r.*").groupBy("model").agg(*[F.sum(c).alias(c) for c in columns])


def long_metrics(metrics: DataFrame) -> DataFrame:
    """``(model, metric, value)`` with report names."""
    columns = [c for c in METRICS if c in metrics.columns]
    entries = F.array(*[F.struct(F.lit(METRICS[c]).alias("metric"), F.col(c).alias("value")) for c in columns])
    return metrics.select("model", F.explode(entries).alias("m")).select("model", "m.metric", "m.value")


def metric_difference(long: DataFrame, a: str = MODEL_A, b: str = MODEL_B) -> DataFrame:
    """Value of both models side by side and b - a, per metric."""
    def of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col("value")))

    return long.groupBy("metric").agg(of(a).alias("model_a"), of(b).alias("model_b"),
                                      (of(b) - of(a)).alias("difference"))
