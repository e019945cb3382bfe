"""From pitches to stored batted balls: cleaning, day-level idempotence and keys."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from inplay.functions import as_date, hit_label
from inplay.operators.prefix import ordered_index
from inplay.schema import DATE_COLUMN, EVENT_COLUMNS, EVENT_SCHEMA, KEY_COLUMN
from inplay.sources.landing import in_days

# Bits of the row hash that cut a day into cells for numbering.
_CELL_BITS = 10


def require_columns_exact(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Return the frame, or raise when names or their order differ."""
    if df.columns != list(expected):
        raise ValueError(f"expected columns {list(expected)}, found {df.columns}")
    return df


def clean_batted_balls(pitches: DataFrame) -> DataFrame:
    """Batted balls of a pitch frame: curated columns, declared types, derived label.

    A source without ``bb_type`` has no batted balls, so the result is empty. NaN counts as missing.
    """
    if "bb_type" not in pitches.columns:
        return pitches.sparkSession.createDataFrame([], EVENT_SCHEMA)
    columns = []
    for field in EVENT_SCHEMA.fields:
        kind = field.dataType.simpleString()
        if field.name == "is_hit":
            c = hit_label("events")
        elif kind == "double":
            c = F.nanvl(F.col(field.name).cast("double"), F.lit(None).cast("double"))
        else:
            c = F.col(field.name).cast(kind)
        columns.append(c.alias(field.name))
    batted = pitches.where(F.col("bb_type").isNotNull()).select(*columns)
    return require_columns_exact(batted, EVENT_COLUMNS)


def date_spine(spark: SparkSession, start: str | date, end: str | date, name: str = DATE_COLUMN) -> DataFrame:
    """One row per day, both ends included; no rows when start is after end."""
    first, last = _day(start), _day(end)
    bounds = spark.range(1).select(F.lit(first).alias("a"), F.lit(last).alias("b"))
    return spine_between(bounds, "a", "b", name)


def spine_between(bounds: DataFrame, first: str, last: str, name: str = DATE_COLUMN) -> DataFrame:
    """Days between two date columns, per row of ``bounds``."""
    # sequence() rejects a descending range, and a null array explodes to no rows.
    days = F.when(F.col(first) <= F.col(last), F.sequence(first, last, F.expr("interval 1 day")))
    return bounds.select(F.explode(days).alias(name))


def loaded_days(table: DataFrame, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Distinct days with at least one stored row, as dates."""
    if start is not None or end is not None:
        table = table.where(in_days(table, _day(start or date.min), _day(end or date.max)))
    return table.select(as_date(DATE_COLUMN).alias(DATE_COLUMN)).distinct()


def unloaded(incoming: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of days that are not stored yet. A day with any stored row is left out as a whole.

    The distinct days are sent to all tasks: by their type there are at most 3.65 million (years 1 to 9999), some
    tens of MB, whatever the tables hold. A join on the day, of all keys the hottest, would shuffle the rows.
    """
    days = F.broadcast(days.select(as_date(DATE_COLUMN).alias("__day")).distinct())
    return incoming.join(days, as_date(DATE_COLUMN) == F.col("__day"), "left_anti")


def days_between(start: str | date, end: str | date) -> int:
    return max(0, (_day(end) - _day(start)).days + 1)


def load_report(stored: DataFrame, incoming: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Per day of the range: what a load would do, and the rows it would add.

    Both sides are cut to the range before they are counted, so each has at most one row per day of it.
    """
    spine = date_spine(stored.sparkSession, start, end)

    def counted(df: DataFrame, name: str) -> DataFrame:
        inside = df.where(in_days(df, _day(start), _day(end)))
        # One row a day at most, see unloaded().
        return F.broadcast(inside.groupBy(as_date(DATE_COLUMN).alias(DATE_COLUMN)).agg(F.count("*").alias(name)))

    joined = (spine.join(counted(stored, "stored_rows"), DATE_COLUMN, "left")
                   .join(counted(incoming, "incoming_rows"), DATE_COLUMN, "left"))
    status = (F.when(F.col("stored_rows").isNotNull(), "already loaded")
               .when(F.col("incoming_rows").isNull(), "no rows")
               .otherwise("loaded"))
    return joined.select(
        DATE_COLUMN, status.alias("status"),
        F.when(status == "loaded", F.col("incoming_rows")).otherwise(F.lit(0).cast("bigint")).alias("loaded_rows"))


def load_total(report: DataFrame) -> DataFrame:
    """Rows added over all days of a load report."""
    return report.agg(F.coalesce(F.sum("loaded_rows"), F.lit(0)).cast("bigint").alias("total_inserted"))


def assign_keys(rows: DataFrame, after: int = 0, name: str = KEY_COLUMN) -> DataFrame:
    """Dense keys ``after + 1, after + 2, ...`` in day order.

    Inside a day rows are ordered by a hash of the whole row, so a day of any size is numbered by many
    tasks, and loading the same rows again gives the same keys (equal rows are interchangeable).
    The result is dealt by ranges of the key and in its order.
    """
    columns = [F.col(c) for c in rows.columns]
    hashed = rows.withColumn("__h", F.xxhash64(*columns))
    cell = F.shiftright(F.col("__h"), 64 - _CELL_BITS)
    keyed = ordered_index(hashed, name, [DATE_COLUMN, cell], [F.col("__h"), *columns], after + 1)
    return keyed.select(name, *rows.columns)


def _day(value: str | date) -> date:
    """Strict YYYY-MM-DD day; anything else raises."""
    return value if isinstance(value, date) else datetime.strptime(value, "%Y-%m-%d").date()
