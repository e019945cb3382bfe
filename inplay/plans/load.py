"""Incremental load of a day range as one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, functions as F

from inplay.operators.ingest import (
    assign_keys, clean_batted_balls, date_spine, days_between, load_report, loaded_days, unloaded,
)
from inplay.schema import DATE_COLUMN, EVENT_COLUMNS, KEY_COLUMN
from inplay.sources.landing import scan_days
from inplay.sources.published import ConcurrentLoad, PublishedTable


class Appendable(Protocol):
    """What a load needs of a table: rows to read, and a way to add some. ``EventTable`` and ``JdbcTable`` are such."""

    def read(self) -> DataFrame: ...

    def append(self, rows: DataFrame) -> None: ...

    def last_key(self) -> int: ...


@dataclass(frozen=True)
class LoadResult:
    total_inserted: int
    report: DataFrame


def rows_to_load(pitches: DataFrame, stored: DataFrame, start: str, end: str) -> DataFrame:
    """Cleaned batted balls of the range whose day is not stored yet."""
    incoming = clean_batted_balls(scan_days(pitches, start, end))
    return unloaded(incoming, loaded_days(stored, start, end)).select(*EVENT_COLUMNS)


def load_range(pitches: DataFrame, table: Appendable, start: str, end: str) -> LoadResult:
    """Append every unstored day of the range and report what happened per day.

    Loading the same range again appends nothing. A day with any stored row is skipped, even if partial.
    The appended rows are those with keys above the last one, so counting them is a read of the new files
    and stays right when tasks are retried. The report names its keys by both ends, so later loads do not change
    it. One load at a time: two at once would give the same keys.
    """
    if not days_between(start, end):
        return LoadResult(0, load_report(table.read(), table.read(), start, end))
    last = table.last_key()
    table.append(assign_keys(rows_to_load(pitches, table.read(), start, end), after=last))
    before = table.read().where(F.col(KEY_COLUMN) <= last)
    inserted = table.read().where(F.col(KEY_COLUMN) > last).count()
    appended = table.read().where((F.col(KEY_COLUMN) > last) & (F.col(KEY_COLUMN) <= last + inserted))
    return LoadResult(inserted, load_report(before, appended, start, end))


def publish_range(pitches: DataFrame, table: PublishedTable, start: str, end: str, attempts: int = 3) -> LoadResult:
    """Load every unstored day of the range so that all of it becomes visible at once.

    Stored days and the last key come from the table's manifests. Rows are staged, counted where they lie and then published;
    a load that dies before leaves the table as it was, and the next one of the same range on the same table
    publishes what was staged whole. If another load publishes meanwhile, this one begins again on top of it. The report has for
    each day what the load did: status, the rows it loaded, and the change of the table's rows (after less before).
    """
    for attempt in range(attempts):
        before, last, stored = table.loads(), table.last_key(), table.manifest()
        if not days_between(start, end):
            return LoadResult(0, published_report(table, before, start, end))
        incoming = clean_batted_balls(scan_days(pitches, start, end))
        fresh = unloaded(incoming, stored.select(DATE_COLUMN)).select(*EVENT_COLUMNS)
        load = table.stage(assign_keys(fresh, after=last), f"{start}_{end}_{last}")
        try:
            table.publish(load, before)
        except ConcurrentLoad:
            if attempt == attempts - 1:
                raise
            continue
        total = table.manifest().where(F.col("load") == load).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        return LoadResult(total, published_report(table, before, start, end))
    raise ValueError("at least one attempt")


def published_report(table: PublishedTable, before: Sequence[str], start: str, end: str) -> DataFrame:
    """Per day of the range what the loads published after ``before`` did to it, from the manifests of now."""
    rows = table.manifest().where(F.col("load").isin(table.loads()))
    was = F.col("load").isin(list(before)) if before else F.lit(False)
    days = F.broadcast(rows.groupBy(DATE_COLUMN).agg(
        F.coalesce(F.sum(F.when(was, F.col("rows"))), F.lit(0)).alias("rows_before"), F.sum("rows").alias("rows_after")))
    joined = date_spine(table.spark, start, end).join(days, DATE_COLUMN, "left")
    status = F.when(F.col("rows_before") > 0, "already loaded").when(F.col("rows_after") > 0, "loaded").otherwise("no rows")
    change = (F.coalesce("rows_after", F.lit(0)) - F.coalesce("rows_before", F.lit(0))).cast("bigint")
    return joined.select(DATE_COLUMN, status.alias("status"), change.alias("loaded_rows"), change.alias("change"))
