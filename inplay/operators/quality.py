"""The data-quality report. Every report is one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from inplay.functions import as_date, as_label, count_where, month_start, percent, rate, season
from inplay.schema import (
    CONTACT_BOUNDS, DATE_COLUMN, HIT_EVENTS, LABEL_COLUMN, MISSING_ALWAYS_TRACKED, MISSING_SWING, Bounds,
)


def period(grain: str, column: str = DATE_COLUMN) -> Column:
    """Bucket of a date column: ``day``, ``month`` or ``year``, under its report name."""
    if grain == "day":
        return as_date(column).alias(column)
    if grain == "month":
        return month_start(column).alias("year_month")
    if grain == "year":
        return season(column).alias("season")
    raise ValueError(f"grain must be day, month or year, not {grain!r}")


def _rows() -> Column:
    return F.count("*")


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(_rows().alias("observations"))


def date_range(df: DataFrame, column: str = DATE_COLUMN) -> DataFrame:
    return df.agg(F.min(column).alias("date_of_first_record"), F.max(column).alias("date_of_last_record"))


def counts_by(df: DataFrame, grain: str, column: str = DATE_COLUMN) -> DataFrame:
    """Rows per period."""
    return df.groupBy(period(grain, column)).agg(_rows().alias("observations"))


def distinct_days(df: DataFrame, column: str = DATE_COLUMN) -> DataFrame:
    return df.agg(F.count_distinct(as_date(column)).alias("total_number_of_days_w_bbe"))


def distinct_days_by_year(df: DataFrame, column: str = DATE_COLUMN) -> DataFrame:
    return df.groupBy(period("year", column)).agg(F.count_distinct(as_date(column)).alias("number_of_days_w_bbe"))


def rate_by(df: DataFrame, grain: str, label: str = LABEL_COLUMN, column: str = DATE_COLUMN) -> DataFrame:
    """Positives, rows and label rate (DECIMAL(5,4)) per period. A null label is in neither side of the rate."""
    positives = F.sum(as_label(label)).cast("bigint")
    return df.groupBy(period(grain, column)).agg(
        positives.alias("total_hits"), _rows().alias("total_bbe"),
        rate(positives, F.count(label)).alias("bbe_hit_rate"))


def null_profile(df: DataFrame, columns: Sequence[str], by: Column | None = None) -> DataFrame:
    """Percent of nulls (two decimals) of each column per season, or per any other grouping."""
    return df.groupBy(period("year") if by is None else by).agg(
        *[percent(count_where(F.col(c).isNull()), _rows()).alias(f"percent_null_{c}") for c in columns])


def null_profile_core(df: DataFrame) -> DataFrame:
    return null_profile(df, MISSING_ALWAYS_TRACKED)


def null_profile_swing(df: DataFrame) -> DataFrame:
    return null_profile(df, MISSING_SWING)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls of each column, and over all of them."""
    columns = list(columns or df.columns)
    counts = [count_where(F.col(c).isNull()).alias(c) for c in columns]
    return df.agg(*counts).withColumn("all_columns", sum((F.col(c) for c in columns), F.lit(0).cast("bigint")))


def _outside(b: Bounds) -> Column:
    sides = []
    if b.high is not None:
        sides.append(F.col(b.column) > F.lit(b.high))
    if b.low is not None:
        sides.append(F.col(b.column) < F.lit(b.low))
    return sides[0] if len(sides) == 1 else sides[0] | sides[1]


def range_profile(df: DataFrame, bounds: Sequence[Bounds] = CONTACT_BOUNDS) -> DataFrame:
    """Row count, and per measure the minimum, maximum and percent outside its typical range."""
    out = [_rows().alias("total_rows")]
    for b in bounds:
        share = F.try_divide(F.lit(100.0) * count_where(_outside(b)), _rows().cast("double"))
        out += [F.min(b.column).alias(f"min_{b.column}"), F.max(b.column).alias(f"max_{b.column}"),
                share.alias(b.label)]
    return df.agg(*out)


def mislabeled_hits(df: DataFrame, hits: Sequence[str] = HIT_EVENTS) -> DataFrame:
    """Labelled as a hit with another outcome. An unknown outcome cannot contradict the label."""
    wrong = F.col(LABEL_COLUMN) & ~F.col("events").isin(*hits)
    return df.where(wrong).agg(_rows().alias("mislabeled_hits"))


def missed_hits(df: DataFrame, hits: Sequence[str] = HIT_EVENTS) -> DataFrame:
    """A hit outcome labelled as none."""
    wrong = ~F.col(LABEL_COLUMN) & F.col("events").isin(*hits)
    return df.where(wrong).agg(_rows().alias("missed_hits"))


def label_consistency(df: DataFrame, hits: Sequence[str] = HIT_EVENTS) -> DataFrame:
    """Both label checks from one scan."""
    listed = F.col("events").isin(*hits)
    return df.agg(count_where(F.col(LABEL_COLUMN) & ~listed).alias("mislabeled_hits"),
                  count_where(~F.col(LABEL_COLUMN) & listed).alias("missed_hits"))
