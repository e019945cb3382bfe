"""Options for reading and appending database tables through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from inplay.schema import DATE_COLUMN, KEY_COLUMN

# Fixed value: rows per insert batch.
BATCH_ROWS = 5000
# Setting names, and the defaults of those that have one.
_REQUIRED = ("DB_NAME", "DB_USER", "DB_PASSWORD")
_DEFAULTS = {"DB_HOST": "localhost", "DB_PORT": "5432", "DB_SCHEMA": "public"}


def connection_options(settings: Mapping[str, str], table: str = "batted_ball_events") -> dict[str, str]:
    """JDBC options from DB_* settings. Missing credentials raise."""
    missing = [k for k in _REQUIRED if not settings.get(k)]
    if missing:
        raise ValueError(f"missing database settings: {missing}")
    full = {**_DEFAULTS, **settings}
    return {
        "url": f"jdbc:postgresql://{full['DB_HOST']}:{full['DB_PORT']}/{full['DB_NAME']}",
        "user": full["DB_USER"], "password": full["DB_PASSWORD"],
        "dbtable": ".".join('"' + p.replace('"', '""') + '"' for p in (full["DB_SCHEMA"], table)),
        "driver": "org.postgresql.Driver",
    }


def partitioned_read(options: Mapping[str, str], first: date, last: date, partitions: int) -> dict[str, str]:
    """Read by day ranges in parallel instead of through one connection."""
    return {**options, "partitionColumn": DATE_COLUMN, "lowerBound": first.isoformat(),
            "upperBound": last.isoformat(), "numPartitions": str(partitions)}


def append_options(options: Mapping[str, str], batch_rows: int = BATCH_ROWS) -> dict[str, str]:
    return {**options, "batchsize": str(batch_rows)}


def read_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def append_table(rows: DataFrame, options: Mapping[str, str]) -> None:
    rows.write.format("jdbc").mode("append").options(**append_options(options)).save()


class JdbcTable:
    """A database table that loads can read and append to: days are read in parallel ranges, rows are inserted in batches."""

    def __init__(self, spark: SparkSession, options: Mapping[str, str], first: date, last: date, partitions: int = 32):
        self.spark, self.options = spark, dict(options)
        self.reading = partitioned_read(options, first, last, partitions)

    def read(self) -> DataFrame:
        return read_table(self.spark, self.reading)

    def last_key(self) -> int:
        """The largest key, asked of the database."""
        query = {**{k: v for k, v in self.options.items() if k != "dbtable"}, "query": f"SELECT max({KEY_COLUMN}) AS last_key FROM {self.options['dbtable']}"}
        return read_table(self.spark, query).first()[0] or 0

    def append(self, rows: DataFrame) -> None:
        append_table(rows, self.options)
