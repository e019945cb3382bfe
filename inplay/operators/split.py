"""Splits by date, and the complete-case rule of controlled comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from inplay.functions import as_date, count_where, percent_text, round_half_even, safe_ratio, thousands
from inplay.operators.checks import ExpectationError, require_rows as require_rows_in
from inplay.sources.landing import in_days
from inplay.schema import BASELINE_WINDOW, DATE_COLUMN, LABEL_COLUMN, MODEL_B_FEATURES, Window


def _check_order(window: Window) -> tuple[date, date, date]:
    start, end, test = (date.fromisoformat(d) for d in (window.train_start, window.train_end, window.test_start))
    if end < start:
        raise ExpectationError("train_end is before train_start")
    if test <= end:
        raise ExpectationError("test_start is not after train_end")
    return start, end, test


def split_column(window: Window = BASELINE_WINDOW, column: str = DATE_COLUMN) -> Column:
    """``train``, ``test``, or null for rows before the training dates or in the gap."""
    start, end, test = _check_order(window)
    day = as_date(column)
    return (F.when(day.between(F.lit(start), F.lit(end)), "train").when(day >= F.lit(test), "test"))


def with_split(df: DataFrame, window: Window = BASELINE_WINDOW, column: str = DATE_COLUMN) -> DataFrame:
    """Rows of either split, tagged. The date filter is kept apart so that it reaches the scan."""
    start, end, test = _check_order(window)
    kept = df.where(in_days(df, start, end, column) | in_days(df, test, date.max, column))
    return kept.withColumn("split", split_column(window, column))


def time_split(df: DataFrame, window: Window = BASELINE_WINDOW, column: str = DATE_COLUMN,
               require_rows: bool = False) -> tuple[DataFrame, DataFrame]:
    """Train and test by date; never random. ``require_rows`` probes both sides for a first row."""
    start, end, test = _check_order(window)
    train, later = (df.where(in_days(df, a, b, column)).withColumn(column, as_date(column))
                    for a, b in ((start, end), (test, date.max)))
    if require_rows:
        require_rows_in(train, "train split")
        require_rows_in(later, "test split")
    return train, later


def complete(df: DataFrame, columns: Sequence[str] = MODEL_B_FEATURES) -> Column:
    """A value in every listed column of ``df``; NaN is none."""
    kinds = dict(df.dtypes)
    known = [F.col(c).isNotNull() & ~F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNotNull() for c in columns]
    return reduce(lambda a, b: a & b, known)


def complete_cases(df: DataFrame, columns: Sequence[str] = MODEL_B_FEATURES) -> DataFrame:
    """Rows with a value in every listed column."""
    return df.where(complete(df, columns))


def row_loss(tagged: DataFrame, columns: Sequence[str] = MODEL_B_FEATURES) -> DataFrame:
    """Rows before and after the complete-case rule, per split, with report text."""
    counted = tagged.groupBy("split").agg(F.count("*").alias("rows_before"),
                                          count_where(complete(tagged, columns)).alias("rows_after"))
    dropped = F.col("rows_before") - F.col("rows_after")
    share = safe_ratio(dropped, F.col("rows_before"))
    return counted.select(
        "split", "rows_before", "rows_after", dropped.alias("rows_dropped"),
        F.round(share, 6).alias("share_dropped"),
        thousands(dropped).alias("dropped_text"), percent_text(share, 2).alias("share_text"))


def split_profile(tagged: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """Rows, date range and label rate (three decimals, half to even) of each split."""
    return tagged.groupBy("split").agg(
        F.count("*").alias("observations"), F.min(DATE_COLUMN).alias("first_date"),
        F.max(DATE_COLUMN).alias("last_date"),
        round_half_even(F.avg(F.col(label).cast("int")), 3).alias("hit_rate"))
