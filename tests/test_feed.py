from datetime import datetime, timedelta

import pytest

from inplay.plans import catalog
from inplay.sources import sample_feed


def nodes(plan):
    yield plan
    for k in range(plan.children().size()):
        yield from nodes(plan.children().apply(k))


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """Lines with repeated rows, null keys and one heavy day."""
    where = str(tmp_path_factory.mktemp("feed"))
    rows = [(None if k % 97 == 0 else k % 301, k % 50, k % 10, k % 7, 100.0 + k % 400, datetime(1995, 1, 2) + timedelta(days=0 if k % 3 else k % 2400)) for k in range(3000)]
    spark.createDataFrame(rows + rows[:40], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp").write.parquet(f"{where}/lineitem.parquet")
    return where


@pytest.mark.parametrize("rows", [sample_feed.laid_out, catalog.surrogate_key])
def test_shuffles_carry_source_columns_alone(spark, lines, rows):
    plan = rows(spark, lines)._jdf.queryExecution().optimizedPlan()
    dealt = [n.output().mkString(" ") for n in nodes(plan) if n.nodeName() in ("RepartitionByExpression", "Window")]
    assert dealt and not any("launch_speed" in x or "bat_speed" in x for x in dealt)


def test_keys_follow_the_order(spark, lines):
    got = sample_feed.laid_out(spark, lines).select("pitch_id", "game_date", "launch_angle").orderBy("pitch_id").collect()
    every = sample_feed.derive(spark, lines).orderBy(*sample_feed.ORDER).collect()
    assert [r.pitch_id for r in got] == list(range(1, len(every) + 1))
    assert [(r.game_date, r.launch_angle) for r in got] == [(r.game_date, r.launch_angle) for r in every]


def test_rows_are_shuffled_once(spark, lines):
    plan = sample_feed.laid_out(spark, lines)._jdf.queryExecution().optimizedPlan()
    dealt = [n.output().mkString(" ") for n in nodes(plan) if n.nodeName() == "RepartitionByExpression"]
    assert sum("l_suppkey" in x for x in dealt) == 1
