"""The stored table of batted balls: one parquet directory per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from inplay.operators.extract import quoted
from inplay.schema import DATE_COLUMN, KEY_COLUMN, TABLE_SCHEMA

TABLE_NAME = "batted_ball_events"


def create_table_sql(name: str = TABLE_NAME, location: str | None = None) -> str:
    columns = ",\n  ".join(
        f"{f.name} {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}" for f in TABLE_SCHEMA.fields)
    place = f"\nLOCATION '{location}'" if location else ""
    return (f"CREATE TABLE IF NOT EXISTS {quoted(name)} (\n  {columns})\nUSING parquet\n"
            f"PARTITIONED BY ({DATE_COLUMN}){place}")


class EventTable:
    """A catalog table with the declared schema.

    Partitioning by day makes the day filter and the list of loaded days a matter of directories. Rows are
    rebalanced by day before a write, so that a quiet day is one file and a heavy day is split over many.
    """

    def __init__(self, spark: SparkSession, name: str = TABLE_NAME, location: str | None = None):
        self.spark = spark
        self.name = name
        spark.sql(create_table_sql(name, location))

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*TABLE_SCHEMA.names)

    def count(self) -> int:
        return self.read().count()

    def has_day(self, day: str) -> bool:
        """Whether any row is stored for the day."""
        probe = f"SELECT 1 FROM {quoted(self.name)} WHERE {DATE_COLUMN} = CAST(:day AS DATE) LIMIT 1"
        return bool(self.spark.sql(probe, args={"day": day}).take(1))

    def last_key(self) -> int:
        return self.read().agg(F.max(KEY_COLUMN)).first()[0] or 0

    def append(self, rows: DataFrame) -> None:
        # saveAsTable matches by name; the partition column is stored last.
        data = [c for c in TABLE_SCHEMA.names if c != DATE_COLUMN]
        (rows.select(*data, DATE_COLUMN).hint("rebalance", DATE_COLUMN)
             .write.mode("append").format("parquet").partitionBy(DATE_COLUMN).saveAsTable(self.name))
