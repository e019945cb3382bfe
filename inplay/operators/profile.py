"""Summaries a person reads before using a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from inplay.functions import count_where, label_text, percent_text, safe_ratio
from inplay.schema import BALL_TYPES_DISPLAY_ORDER, DATE_COLUMN, KEY_COLUMN, LABEL_COLUMN, SAMPLE_SEED, SAMPLE_SIZE


def pull_profile(batted: DataFrame) -> DataFrame:
    """Shape, number of outcomes and ball types (null counts as one), and their missing shares."""
    def kinds(c: str) -> Column:
        return F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))

    def missing(c: str) -> Column:
        return safe_ratio(count_where(F.col(c).isNull()), F.count("*"))

    return batted.agg(
        F.count("*").alias("n_rows"), F.lit(len(batted.columns)).cast("bigint").alias("n_columns"),
        kinds("events").cast("bigint").alias("n_events"), kinds("bb_type").cast("bigint").alias("n_bb_types"),
        missing("events").alias("missing_events"), missing("bb_type").alias("missing_bb_type"))


def distinct_values(df: DataFrame, column: str | Column) -> DataFrame:
    return df.select(column).distinct()


def extract_profile(extract: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """Shape, label type, date range and number of years."""
    return extract.agg(
        F.count("*").alias("n_rows"), F.lit(len(extract.columns)).cast("bigint").alias("n_columns"),
        F.lit(extract.schema[label].dataType.simpleString()).alias("label_type"),
        F.min(DATE_COLUMN).alias("first_date"), F.max(DATE_COLUMN).alias("last_date"),
        F.count_distinct(F.year(DATE_COLUMN)).alias("n_years"))


def value_counts(df: DataFrame, column: str = LABEL_COLUMN, top: int = 5) -> DataFrame:
    """The most frequent values; equal counts in value order."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("observations"))
    return counted.orderBy(F.desc("observations"), F.col(column)).limit(top)


def head_tail(df: DataFrame, order: Sequence[str] = (DATE_COLUMN, KEY_COLUMN), n: int = 3) -> DataFrame:
    """First and last n rows in the given order, tagged ``head`` and ``tail``."""
    first = df.orderBy(*[F.asc(c) for c in order]).limit(n).withColumn("part", F.lit("head"))
    last = df.orderBy(*[F.desc(c) for c in order]).limit(n).withColumn("part", F.lit("tail"))
    return first.unionByName(last)


def sample_n(df: DataFrame, n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED, key: str = KEY_COLUMN,
             draw: Column | None = None) -> DataFrame:
    """Exactly n rows without replacement, the same rows on every run.

    Rows with the smallest seeded hash of their key are taken: each task keeps at most n.
    """
    draw = F.xxhash64(F.col(key), F.lit(seed)) if draw is None else draw
    return df.orderBy(draw, F.col(key)).limit(n)


def labelled_sample(df: DataFrame, columns: Sequence[str] = ("launch_angle", "launch_speed"), **kwargs) -> DataFrame:
    """A sample of two measures with the label as text."""
    return sample_n(df, **kwargs).select(*columns, label_text(LABEL_COLUMN).alias(LABEL_COLUMN))


def label_rate_by(df: DataFrame, column: str = "bb_type", label: str = LABEL_COLUMN,
                  order: Sequence[str] = BALL_TYPES_DISPLAY_ORDER) -> DataFrame:
    """Label rate per listed value, with its display rank and text."""
    rank = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column)).cast("int")
    rates = (df.where(F.col(column).isin(*order)).groupBy(column)
               .agg(safe_ratio(F.sum(F.col(label).cast("int")), F.count(label)).alias("hit_rate")))
    return rates.select(column, rank.alias("display_rank"), "hit_rate",
                        percent_text(F.col("hit_rate")).alias("hit_rate_text"))
