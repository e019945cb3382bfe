"""Every registered query against the same result from DuckDB."""

import pytest

import __spark_entry__ as entry_point
import comparing

QUERIES = entry_point.queries()
ORACLE = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return comparing.connect(sf)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark, sf):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    ours = comparing.spark_rows(df)
    assert ours[1], "no rows"
    assert comparing.type_difference(df, duck, ORACLE[name]) is None
    assert comparing.difference(ours, comparing.duckdb_rows(duck, ORACLE[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_without_sql_gives_rows(name, spark, sf):
    assert comparing.spark_rows(QUERIES[name](spark, sf))[1]
