import random

import pytest
from pyspark.sql import functions as F

from inplay.operators.prefix import ordered_index, running_totals
from inplay.operators.quantiles import exact_quantiles


def brute(rows, key):
    out, total = {}, 0
    for r in sorted(rows, key=key):
        total += r[2]
        out[r[0]] = total
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("levels", [[], [8], [64, 8]])
def test_running_totals(spark, seed, levels):
    rng = random.Random(seed)
    # One third of the rows share the top cell.
    positions = rng.sample(range(64), 40) + rng.sample(range(64, 5000), 80)
    rows = [(i, p, rng.randrange(10)) for i, p in enumerate(positions)]
    df = spark.createDataFrame(rows, "id int, pos int, n int")
    cells = [F.floor(F.col("pos") / w) for w in levels]
    got = running_totals(df, {"upto": F.col("n")}, cells, [F.col("pos")], grand_suffix="_all",
                         ahead={"next": F.col("id")}).collect()
    expected = brute(rows, lambda r: r[1])
    assert {r["id"]: r["upto"] for r in got} == expected
    assert {r["upto_all"] for r in got} == {sum(r[2] for r in rows)}
    order = [r[0] for r in sorted(rows, key=lambda r: r[1])]
    assert {r["id"]: r["next"] for r in got} == dict(zip(order, order[1:] + [None]))


def test_groups_and_null_cells_keep_all_rows(spark):
    rows = [("a", None, 1), ("a", 3, 2), (None, 1, 4), (None, None, 8), ("b", 2, 16)]
    df = spark.createDataFrame(rows, "g string, pos int, n int")
    got = running_totals(df, {"upto": F.col("n")}, [F.col("pos")], [F.col("pos")], within=["g"]).collect()
    assert sorted((str(r["g"]), r["n"], r["upto"]) for r in got) == [
        ("None", 4, 12), ("None", 8, 8), ("a", 1, 1), ("a", 2, 3), ("b", 16, 16)]


def test_index_is_dense_and_ordered(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("pos"))
    got = ordered_index(df, "i", [F.floor(F.col("pos") / 100)], [F.col("pos")], start=501)
    rows = sorted((r["pos"], r["i"]) for r in got.collect())
    assert rows == [(p, p + 501) for p in range(1000)]


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [5.0, 1.0, 3.0], [2.0, 2.0, 2.0, 9.0], [1.0, 1.0, 4.0, 4.0],
    [float(i) for i in range(1, 1001)], [7.0] * 500 + [float(i) for i in range(1000)],
    [-1e9, -1.5, 0.0, 1e-9, 3e12, None, None],
])
@pytest.mark.parametrize("q", [0.5, 0.25, 1.0])
def test_exact_quantile(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "x double").withColumn("y", -F.col("x"))
    got = exact_quantiles(df, ["x", "y"], q)
    known = sorted(v for v in values if v is not None)

    def expected(vs):
        at = (len(vs) - 1) * q
        low = int(at)
        high = min(low + 1, len(vs) - 1)
        return vs[low] + (vs[high] - vs[low]) * (at - low)

    assert got["x"] == pytest.approx(expected(known), rel=1e-12)
    assert got["y"] == pytest.approx(expected([-v for v in reversed(known)]), rel=1e-12)


def test_quantile_with_a_coarse_sketch_stays_exact(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).cast("double").alias("x"))
    values = sorted(float(i * 7919 % 20_011) for i in range(20_000))
    assert exact_quantiles(df, ["x"], 0.5, accuracy=20)["x"] == (values[9999] + values[10_000]) / 2


def test_quantile_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "x double"), ["x"]) == {"x": None}


def test_index_comes_dealt_and_in_order(spark):
    """A position's rows lie in its order, over several tasks; null levels come first, equal rows get different positions."""
    values = [None if i % 13 == 0 else i * 37 % 101 for i in range(500)]
    df = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)], "day long, part long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        indexed = ordered_index(df, "i", ["day", F.shiftright("part", 1)], [F.col("part")], start=10)
        got = indexed.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.i for r in got] == list(range(10, 510)) and len({r.task for r in got}) > 1
    want = sorted(((-1 if v is None else v), i % 7) for i, v in enumerate(values))
    assert [(-1 if r.day is None else r.day, r.part) for r in got] == want
