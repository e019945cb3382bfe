"""Pitch scans from a landing zone."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from inplay.schema import DATE_COLUMN


def in_days(df: DataFrame, start: str | date, end: str | date, column: str = DATE_COLUMN) -> Column:
    """Inclusive day range on a date, timestamp or ISO text column, comparing the bare column with
    literals of its own type so that the predicate reaches the scan."""
    first = start if isinstance(start, date) else date.fromisoformat(start)
    last = end if isinstance(end, date) else date.fromisoformat(end)
    kind = df.schema[column].dataType
    if last == date.max:
        return F.col(column) >= F.lit(first.isoformat() if isinstance(kind, T.StringType) else first).cast(kind)
    after = last + timedelta(days=1)
    if isinstance(kind, T.StringType):
        return (F.col(column) >= F.lit(first.isoformat())) & (F.col(column) < F.lit(after.isoformat()))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        name = kind.simpleString()
        return (F.col(column) >= F.lit(first).cast(name)) & (F.col(column) < F.lit(after).cast(name))
    return F.col(column).between(F.lit(first), F.lit(last))


def scan_days(df: DataFrame, start: str | date, end: str | date, column: str = DATE_COLUMN) -> DataFrame:
    return df.where(in_days(df, start, end, column))


def scan_pitches(
    spark: SparkSession, path: str | list[str], start: str | date, end: str | date,
    format: str = "parquet", schema: T.StructType | None = None, **options: str,
) -> DataFrame:
    """All pitches of an inclusive day range.

    Give a schema for CSV and JSON: without one Spark reads the data twice to infer it. Parquet and ORC
    carry their own. ``format='jdbc'`` reads a table given by options.
    """
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    source = reader.load() if format == "jdbc" else reader.load(path)
    return scan_days(source, start, end)
