"""What the physical plans must look like for large tables."""

import re

import pytest
from pyspark.sql import functions as F

from inplay.operators import extract, ingest, metrics, quality, split
from inplay.operators.prefix import ordered_index
from inplay.plans import catalog
from inplay.schema import DATE_COLUMN, KEY_COLUMN
from inplay.sources.table import EventTable

# These fit a model or validate while they are built; their parts are covered by the others.
EAGER = {n for n in catalog.queries() if n.startswith("fit") or n.endswith("_experiment")} | {
    "score_test", "ab_comparison", "median_impute", "standardize", "one_hot", "mode_impute",
    "feature_display_names", "load_modeling_extract"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf):
    table = EventTable(spark, "plan_events")
    if table.count() == 0:
        late = catalog._table(spark, sf).where(F.col(DATE_COLUMN) >= F.lit("2025-03-01").cast("date"))
        table.append(late)
    yield table.read()
    spark.sql("DROP TABLE plan_events")


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - EAGER))
def test_no_python_and_no_pairwise_joins(name, spark, sf):
    text = plan(catalog.queries()[name](spark, sf))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert word not in text


def test_extract_filters_reach_the_scan(stored):
    text = plan(extract.modeling_extract(stored))
    filters = re.search(r"PartitionFilters: (.*?)PushedFilters: (.*?)ReadSchema: (.*)", text)
    assert "game_date" in filters[1] and "2021-04-01" in filters[1]
    assert "IsNotNull(launch_speed)" in filters[2] and "IsNotNull(launch_angle)" in filters[2]
    assert "hc_x" not in filters[3] and "zone" not in filters[3]
    assert "Exchange" not in text


def test_split_prunes_days(stored):
    _, test = split.time_split(stored)
    assert "2025-01-01" in re.search(r"PartitionFilters: (.*?)PushedFilters", plan(test))[1]


def test_reports_read_only_their_columns(stored):
    text = plan(quality.rate_by(stored, "year"))
    assert re.search(r"ReadSchema: (\S+)", text)[1].startswith("struct<is_hit:boolean>")
    text = plan(quality.range_profile(stored))
    assert text.count("FileScan") == 1 and "hc_x" not in text


def test_distinct_days_are_broadcast(stored):
    """There are never more of them than a date can have."""
    assert "BroadcastExchange" in plan(ingest.unloaded(stored, ingest.loaded_days(stored)))


def windows_on_one_task(text):
    """Depth-first: whether any single-partition window sits on rows that were not aggregated before."""
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            above = lines[i - 2] + lines[i - 1]
            if "Window" in above and "HashAggregate" not in lines[i + 1]:
                return True
    return False


def test_numbering_never_sorts_all_rows_in_one_task(stored):
    keyed = ordered_index(stored, "i", [F.col(DATE_COLUMN), F.shiftright(KEY_COLUMN, 10)], [F.col(KEY_COLUMN)])
    text = plan(keyed)
    assert "Window" in text and not windows_on_one_task(text)
    naive = stored.selectExpr("row_number() over (order by batted_ball_id) as i")
    assert windows_on_one_task(plan(naive))


def test_evaluation_scans_once(spark, stored):
    scored = stored.select("is_hit", F.expr(catalog.SCORE_A).alias("p"))
    result = metrics.evaluation(scored, "p", "is_hit")
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
