import math
import random

import pytest
from pyspark.sql import functions as F

from inplay.operators import metrics


def frame(spark, rows, model=None):
    if model is None:
        return spark.createDataFrame(rows, "label int, p double")
    return spark.createDataFrame([(m, *r) for m, r in zip(model, rows)], "model string, label int, p double")


def rank_auc(rows):
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def step_precision(rows):
    total, out = sum(y for y, _ in rows), 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        at = [y for y, p in rows if p == t]
        above = [y for y, p in rows if p >= t]
        out += sum(at) / total * sum(above) / len(above)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_ranking_metrics(spark, seed):
    rng = random.Random(seed)
    # A third of the rows share one score; others are ties, edges or spread out.
    rows = [(rng.randrange(2), rng.choice([0.5, 0.5, 0.0, 1.0, rng.random(), rng.randrange(5) / 5])) for _ in range(300)]
    got = metrics.evaluation(frame(spark, rows)).first()
    assert got["roc_auc"] == pytest.approx(rank_auc(rows), abs=1e-12)
    assert got["average_precision"] == pytest.approx(step_precision(rows), abs=1e-12)
    assert got["observed_hit_rate"] == pytest.approx(sum(y for y, _ in rows) / 300)
    assert got["expected_hit_rate"] == pytest.approx(sum(p for _, p in rows) / 300)


def test_close_scores_and_scores_outside_the_span(spark):
    tiny = 2.0**-52
    rows = [(1, 0.5 + tiny), (0, 0.5), (1, 0.5 - tiny), (0, -3.0), (1, 7.0), (0, 9.0)]
    got = metrics.evaluation(frame(spark, rows)).first()
    assert got["roc_auc"] == pytest.approx(rank_auc(rows), abs=1e-12)
    assert got["average_precision"] == pytest.approx(step_precision(rows), abs=1e-12)


def test_decision_rules_differ_at_one_half(spark):
    df = frame(spark, [(1, 0.5), (0, 0.4), (1, 0.6), (0, 0.5)])
    inclusive = metrics.evaluation(df).first()
    strict = metrics.evaluation(df, strict_decision=True).first()
    assert (inclusive["precision"], inclusive["recall"], inclusive["specificity"]) == (2 / 3, 1.0, 0.5)
    assert (strict["precision"], strict["recall"], strict["specificity"]) == (1.0, 0.5, 1.0)
    assert inclusive["predicted_hits_at_threshold"] == strict["predicted_hits_at_threshold"] == 0.75
    counts = {(r["actual"], r["predicted"]): r["observations"] for r in metrics.confusion_matrix(df).collect()}
    assert counts == {(1, 0): 1, (1, 1): 1, (0, 0): 2}


def test_zero_denominators(spark):
    none = metrics.evaluation(frame(spark, [(0, 0.1), (0, 0.2)])).first()
    assert (none["precision"], none["recall"], none["f1"], none["average_precision"]) == (0.0, 0.0, 0.0, 0.0)
    assert none["roc_auc"] is None and none["specificity"] == 1.0
    every = metrics.evaluation(frame(spark, [(1, 0.9)])).first()
    assert every["specificity"] == 0.0 and every["roc_auc"] is None and every["f1"] == 1.0


def curve(rows, drop):
    scores = sorted({p for _, p in rows}, reverse=True)
    pts = [(t, sum(1 - y for y, p in rows if p >= t), sum(y for y, p in rows if p >= t)) for t in scores]
    if drop and len(pts) > 2:
        def flat(i, k):
            return pts[i + 1][k] - 2 * pts[i][k] + pts[i - 1][k] == 0
        pts = [pts[i] for i in range(len(pts)) if i in (0, len(pts) - 1) or not (flat(i, 1) and flat(i, 2))]
    n, p = sum(1 - y for y, _ in rows), sum(y for y, _ in rows)
    return [(math.inf, 0.0, 0.0)] + [(t, a / n, b / p) for t, a, b in pts]


@pytest.mark.parametrize("drop", [False, True])
def test_roc_points(spark, drop):
    rng = random.Random(5)
    rows = [(rng.randrange(2), rng.randrange(40) / 40) for _ in range(70)]
    got = [tuple(r) for r in metrics.roc_curve(frame(spark, rows), drop_intermediate=drop).collect()]
    assert sorted(got, reverse=True) == curve(rows, drop)
    if drop:
        assert len(got) < len(curve(rows, False))


def test_groups_are_separate(spark):
    rows = [(1, 0.9), (0, 0.1), (1, 0.1), (0, 0.9)]
    df = frame(spark, rows, ["a", "a", None, None])
    got = {r["model"]: r["roc_auc"] for r in metrics.evaluation(df, by=["model"]).collect()}
    assert got == {"a": 1.0, None: 0.0}
    points = metrics.roc_curve(df, by=["model"]).collect()
    assert len(points) == 6


def test_difference_row(spark):
    rows = [("Model A", 0.25, 1.0), ("Model B", 0.5, 0.75)]
    df = spark.createDataFrame(rows, "model string, accuracy double, f1 double")
    got = {r["model"]: (r["accuracy"], r["f1"]) for r in metrics.with_difference(df).collect()}
    assert got == {"Model A": (0.25, 1.0), "Model B": (0.5, 0.75), metrics.DIFFERENCE: (0.25, -0.25)}
    long = metrics.metric_difference(metrics.long_metrics(df)).collect()
    assert {r["metric"]: r["difference"] for r in long} == {"Accuracy": 0.25, "F1": -0.25}


def test_saturated_scores_are_spread_over_cells_in_order(spark):
    low = spark.range(10_000).select((F.col("id") * 1e-13 + 1e-300).alias("score"))
    high = low.select((1 - F.col("score") * 1000).alias("score"))
    middle = spark.range(1_000).select((F.col("id") / 1000).alias("score"))
    edges = spark.createDataFrame([(x,) for x in (-3.0, 0.0, 5e-324, 0.5, 1.0, 7.0)], "score double")
    coarse, fine = metrics._cells(1.0, 0.0)
    for part in (low, high):
        assert part.select(fine).distinct().count() > 1_000
    rows = low.union(high).union(middle).union(edges).select("score", coarse.alias("coarse"), fine.alias("fine")).collect()
    rows.sort(key=lambda r: -r["score"])
    for name in ("coarse", "fine"):
        cells = [r[name] for r in rows]
        assert cells == sorted(cells)
    assert 0 <= rows[0]["coarse"] and rows[-1]["coarse"] < 2**14
    assert max(r["fine"] for r in rows) < 2**28
