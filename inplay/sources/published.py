"""A stored table whose loads become visible as a whole: rows are staged first, then a manifest of their days is published.

A load writes its rows to a directory of its own, which no reader looks at. Publishing renames one small manifest (a row for
each day: rows, first and last key) to the next number; the rename fails if another load has taken the number. Readers
take the loads of the manifests they see, so a day is there wholly or not at all, and a load that died leaves nothing but
a directory that the next load goes on with or ``vacuum`` deletes. Which days are stored and the last key come from
the manifests, without a look at the data. The folder has to be on a file system whose rename is atomic.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from inplay.schema import DATE_COLUMN, KEY_COLUMN, TABLE_SCHEMA

MANIFEST_SCHEMA = T.StructType([
    T.StructField(DATE_COLUMN, T.DateType(), False), T.StructField("rows", T.LongType(), False),
    T.StructField("first_key", T.LongType(), False), T.StructField("last_key", T.LongType(), False),
    T.StructField("load", T.StringType(), False)])


# Begins the name of the empty file that names a manifest's load.
_NAMED = "_load-"


class ConcurrentLoad(RuntimeError):
    """Another load has published since this one began; what it staged was numbered for an older table."""


class PublishedTable:
    """Rows of the declared schema under ``location``, a directory for each load and in it for each day."""

    def __init__(self, spark: SparkSession, location: str, schema: T.StructType = TABLE_SCHEMA, day: str = DATE_COLUMN, key: str = KEY_COLUMN):
        self.spark, self.schema, self.day, self.key = spark, schema, day, key
        self.location = location.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path(self.location).getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in (self._data(), self._published()):
            self._fs.mkdirs(self._path(folder))

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _data(self, load: str | None = None) -> str:
        return f"{self.location}/data" + (f"/load={load}" if load else "")

    def _published(self) -> str:
        return f"{self.location}/published"

    def _names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))

    def _numbers(self) -> list[str]:
        return [n for n in self._names(self._published()) if not n.startswith("_")]

    def loads(self) -> list[str]:
        """Names of the published loads in their order: as many as there were loads, from directory listings."""
        return [next(n.removeprefix(_NAMED) for n in self._names(f"{self._published()}/{number}") if n.startswith(_NAMED)) for number in self._numbers()]

    def manifest(self) -> DataFrame:
        """(day, rows, first_key, last_key, load) of the published loads: a row for each day, whatever the days hold."""
        paths = [f"{self._published()}/{number}" for number in self._numbers()]
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], MANIFEST_SCHEMA)

    def days(self) -> DataFrame:
        """The stored days, from the manifests alone."""
        return self.manifest().select(F.col(DATE_COLUMN).alias(self.day)).distinct()

    def read(self, loads: Sequence[str] | None = None) -> DataFrame:
        """The rows of the published loads, as of this call."""
        known = self.loads() if loads is None else list(loads)
        if not known:
            return self.spark.createDataFrame([], self.schema)
        return self._read([self._data(load) for load in known])

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", self._data()).schema(self.schema).parquet(*paths).select(*self.schema.names)

    def count(self) -> int:
        """Stored rows, from the manifests."""
        return self.manifest().agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def last_key(self) -> int:
        """The largest key, from the manifests; 0 for an empty table."""
        return self.manifest().agg(F.coalesce(F.max("last_key"), F.lit(0))).first()[0]

    def stage(self, rows: DataFrame, label: str) -> str:
        """Write rows with their keys where no reader sees them, and return the name of the load.

        ``label`` says what is loaded on top of what; a whole stage of the same label, left by a load that died, is taken
        instead of writing it again. Rows are written as they lie: ``assign_keys`` gives them in ranges of the day; others are better dealt by the day first.
        """
        for name in self._names(self._data()):
            load = name.removeprefix("load=")
            if load.startswith(f"{label}-") and load not in self.loads() and self._fs.exists(self._path(f"{self._data(load)}/_SUCCESS")):
                return load
        load = f"{label}-{uuid.uuid4().hex}"
        data = [c for c in self.schema.names if c != self.day]
        # A quiet day is one file, or two at the end of a range; a heavy day is split over many.
        rows.select(*data, self.day).write.partitionBy(self.day).parquet(self._data(load))
        return load

    def publish(self, load: str, after: Sequence[str]) -> None:
        """Make a staged load visible, if the published loads are still ``after``."""
        staged = self._read([self._data(load)]) if self._has_files(load) else self.spark.createDataFrame([], self.schema)
        found = staged.groupBy(F.col(self.day).alias(DATE_COLUMN)).agg(
            F.count("*").alias("rows"), F.min(self.key).alias("first_key"), F.max(self.key).alias("last_key")).withColumn("load", F.lit(load))
        draft = f"{self._published()}/_draft-{uuid.uuid4().hex}"
        found.coalesce(1).write.parquet(draft)
        self._fs.create(self._path(f"{draft}/{_NAMED}{load}")).close()
        # Numbers follow each other, so a load that was published meanwhile has this one, and the rename fails.
        try:
            self._rename(draft, f"{self._published()}/{len(after):08d}")
        except Py4JJavaError as taken:
            self._fs.delete(self._path(draft), True)
            raise ConcurrentLoad(load) from taken

    def _rename(self, source: str, target: str) -> None:
        """Rename to a name that is free; unlike FileSystem.rename, this never moves into a directory of that name."""
        hadoop = self._jvm.org.apache.hadoop.fs
        none = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        context = hadoop.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(self._path(source), self._path(target), none)

    def _has_files(self, load: str) -> bool:
        return any(n.startswith(f"{self.day}=") for n in self._names(self._data(load)))

    def vacuum(self) -> list[str]:
        """Delete what loads have staged and never published, and return their names. No load may run meanwhile."""
        known = set(self.loads())
        gone = [n.removeprefix("load=") for n in self._names(self._data()) if n.removeprefix("load=") not in known]
        for load in gone:
            self._fs.delete(self._path(self._data(load)), True)
        for name in self._names(self._published()):
            if name.startswith("_"):
                self._fs.delete(self._path(f"{self._published()}/{name}"), True)
        return gone
