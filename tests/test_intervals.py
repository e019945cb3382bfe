import random
from datetime import date, datetime, timedelta

import pytest

from inplay.operators import intervals

SPAN = "a long, b long"


def joined(spark, points, spans):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "id long, at long")
    return df, intervals.interval_semi_join(df, "at", spark.createDataFrame(spans, SPAN), "a", "b")


@pytest.mark.parametrize("width", [3, 40, 5000, 10 ** 12])
def test_equal_to_comparing_all(spark, width):
    rng = random.Random(width)
    spans = [(a, a + rng.randrange(-2, width)) for a in (rng.randrange(-10 * width, 10 * width) for _ in range(60))] + [(None, 5), (5, None)]
    points = [rng.randrange(-11 * width, 11 * width) for _ in range(400)] + [p for a, b in spans if a and b for p in (a - 1, a, b, b + 1)] + [None]
    _, got = joined(spark, points, spans)
    want = [i for i, p in enumerate(points) if p is not None and any(a is not None and b is not None and a <= p <= b for a, b in spans)]
    assert sorted(r.id for r in got.collect()) == want


def test_pieces_are_few_and_apart(spark):
    spans = [(3, 10 ** 15), (5, 6), (-1, 2), (10 ** 16, 10 ** 16)]
    rows = [(r.level, r.piece) for r in intervals.pieces(spark.createDataFrame(spans, SPAN), "a", "b").collect()]
    assert len(rows) < 2 * 15 * 14
    covered = sorted((p << 4 * n, (p + 1) << 4 * n) for n, p in rows)
    assert all(x[1] <= y[0] for x, y in zip(covered, covered[1:]))
    assert sum(b - a for a, b in covered) == 10 ** 15 + 2 + 1


def test_no_intervals_and_equal_points(spark):
    df, got = joined(spark, [1, 1, 2], [(9, 3)])
    assert got.columns == df.columns and got.count() == 0
    assert joined(spark, [1, 1, 2], [(0, 1), (1, 1), (0, 1)])[1].count() == 2


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_days_and_times(spark, kind):
    base = datetime(1969, 12, 30)
    points = [base + timedelta(hours=7 * k, microseconds=k) for k in range(40)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "id long, at timestamp_ntz").selectExpr("id", f"CAST(at AS {kind}) AS at")
    spans = spark.createDataFrame([(points[3], points[9]), (points[30], points[30])], "a timestamp_ntz, b timestamp_ntz").selectExpr(f"CAST(a AS {kind}) a", f"CAST(b AS {kind}) b")
    cut = (lambda x: x.date()) if kind == "date" else (lambda x: x)
    want = [i for i, p in enumerate(points) if cut(points[3]) <= cut(p) <= cut(points[9]) or cut(p) == cut(points[30])]
    assert sorted(r.id for r in intervals.interval_semi_join(df, "at", spans, "a", "b").collect()) == want
    assert date(1969, 12, 30) == base.date()


def test_plan_is_a_hash_join(spark):
    _, got = joined(spark, list(range(50)), [(3, 9)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", ["apart", "overlapping", "one long"])
def test_pieces_and_rows_do_not_grow_with_the_length_of_spans(spark, name):
    """A fine scale gave each span up to 200 pieces; what is joined is now at most a run for each span and one for each cell."""
    n, minute = 3000, 60_000_000
    spans = {"apart": [(k * 10 * minute + 7 * k, k * 10 * minute + 4 * minute + k) for k in range(n)],
             "overlapping": [(k * minute // 10 + 7 * k, k * minute // 10 + 4 * minute + k) for k in range(n)],
             "one long": [(0, n * minute)] + [(k * minute + 3, k * minute + 9) for k in range(n)]}[name]
    df = spark.createDataFrame(spans, SPAN)
    bounds, runs = intervals.merged(df, "a", "b")
    rows = [(r.cell, r.low, r.high) for r in runs.orderBy("low").collect()]
    assert len(rows) <= n + len(bounds) and (name == "apart" or len(rows) <= len(bounds) + 1)
    assert all(x[2] <= y[1] for x, y in zip(rows, rows[1:]))
    at = [p for a, b in spans[::50] for p in (a - 1, a, (a + b) // 2, b, b + 1)]
    want = [i for i, p in enumerate(at) if any(a <= p <= b for a, b in spans)]
    assert [r.id for r in joined(spark, at, spans)[1].orderBy("id").collect()] == want


def test_numbers_beyond_those_that_a_double_holds(spark):
    rng, base = random.Random(5), 1 << 61
    spans = [(base + a, base + a + rng.randrange(9)) for a in rng.sample(range(40_000), 2500)]
    at = [base + rng.randrange(-5, 40_050) for _ in range(3000)]
    want = [i for i, p in enumerate(at) if any(a <= p <= b for a, b in spans)]
    assert [r.id for r in joined(spark, at, spans)[1].orderBy("id").collect()] == want
