"""Session settings this package is tuned with."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffles, splits skewed join and write partitions and turns a join
# into a broadcast only after the measured size of the side allows it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Generated methods above 8000 bytes are not compiled by the JVM; such a stage is faster without them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "inplay", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for ``.`` and win.

    Adaptive execution merges small shuffle partitions but never adds any: for large inputs give
    ``spark__sql__shuffle__partitions`` as about the shuffled bytes over 128 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables that jobs hand on: ``spark.checkpoint.dir``, which all executors must reach.

    Only a local session may do without; it gets a temporary folder that is removed at exit.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="inplay-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
