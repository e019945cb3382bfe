"""The modeling extract: which rows and columns may enter a model."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inplay.functions import as_date
from inplay.operators import checks
from inplay.sources.landing import in_days
from inplay.schema import DATE_COLUMN, EXTRACT_COLUMNS, LABEL_COLUMN, REQUIRED_MEASURES, SEASON_WINDOWS


def in_seasons(df: DataFrame, column: str = DATE_COLUMN, windows: Sequence[tuple] = SEASON_WINDOWS) -> Column:
    """Inside any season window. Literals of the column's type, so the predicate reaches the scan."""
    return reduce(or_, [in_days(df, a, b, column) for _, a, b in windows])


def measured(columns: Sequence[str] = REQUIRED_MEASURES) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def modeling_extract(events: DataFrame, windows: Sequence[tuple] = SEASON_WINDOWS,
                     columns: Sequence[str] = EXTRACT_COLUMNS) -> DataFrame:
    """Regular-season rows with both launch measures, without columns that leak the outcome."""
    return events.where(in_seasons(events, windows=windows) & measured()).select(*columns)


def season_calendar(spark: SparkSession, windows: Sequence[tuple] = SEASON_WINDOWS) -> DataFrame:
    rows = ", ".join(f"({s}, DATE '{a}', DATE '{b}')" for s, a, b in windows)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS calendar(season, season_start, season_end)")


def semi_join_seasons(events: DataFrame, calendar: DataFrame, column: str = DATE_COLUMN) -> DataFrame:
    """Rows inside any interval of a calendar table.

    Each interval is listed under every year it touches, so the join has an equality on the year and is
    a hash join with a residual range, not a comparison of every row with every interval.
    """
    years = calendar.select(
        F.explode(F.sequence(F.year("season_start"), F.year("season_end"))).alias("__year"),
        "season_start", "season_end")
    inside = (F.year(F.col(column)) == F.col("__year")) & F.col(column).between(
        F.col("season_start"), F.col("season_end"))
    return events.join(years, inside, "left_semi")


def view_sql(source: str, name: str = "modeling_extract", temporary: bool = True,
             windows: Sequence[tuple] = SEASON_WINDOWS) -> str:
    """The same extract as a re-runnable view definition over a table or view."""
    seasons = "\n    OR ".join(f"game_date BETWEEN DATE '{a}' AND DATE '{b}'" for _, a, b in windows)
    present = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_MEASURES)
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    return (f"CREATE OR REPLACE {kind} {quoted(name)} AS\nSELECT {', '.join(EXTRACT_COLUMNS)}\n"
            f"FROM {quoted(source)}\nWHERE ({seasons})\n  AND {present}")


def quoted(name: str) -> str:
    """Back-quote each part of a table name."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_view(spark: SparkSession, source: str, name: str = "modeling_extract", temporary: bool = True) -> DataFrame:
    spark.sql(view_sql(source, name, temporary))
    return spark.table(name)


def load_modeling_extract(view: DataFrame, validate: bool = True) -> DataFrame:
    """The extract as models read it: required columns, dates as days, a complete 0/1 label.

    Rows come in no order: sort where the result is shown, not before further work.
    """
    checks.require_columns(view.columns)
    checks.require_binary_type(view, LABEL_COLUMN)
    df = view.withColumn(DATE_COLUMN, as_date(DATE_COLUMN))
    if validate:
        checks.validate(df, checks.extract_expectations(), strict=True)
    return df
