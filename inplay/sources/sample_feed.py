"""A pitch feed and a stored batted-ball table derived from the ``lineitem`` test table.

The expressions are portable SQL text, so the same rows can be derived by another engine for checking.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from inplay.operators.prefix import ordered_index
from inplay.schema import EVENT_COLUMNS, KEY_COLUMN, SWING_NUMERIC
from inplay.session import shared_folder

# Ship dates move by 24 years (8766 days) into the seasons 2019 to 2025; leap years stay leap years.
BASE = {
    "game_date": "CAST(l_shipdate AS DATE) + 8766",
    "cents": "CAST(round(l_extendedprice * 100) AS BIGINT)",
    "h": "l_orderkey * 7 + l_linenumber * 13 + l_partkey",
}
ORDER = ["game_date", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cents"]
_SOURCE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

_ANGLE = "((h * 31) % 171 - 85)"
# Offset, factor, modulus and divisor of each swing measure, with the day tracking began.
_SWING = dict(zip(SWING_NUMERIC, [
    (500, 3, 401), (40, 5, 61), (-300, 19, 601), (-150, 23, 501), (150, 29, 301), (200, 37, 251), (150, 41, 301)]))

# A pitch that is put in play becomes a hit with a chance that depends on its ball type and speed. It is
# written on h and cents, not on the columns derived from them, so that a filter on it stays short.
_CHANCE = (f"CASE WHEN h % 5 = 0 OR {_ANGLE} < 10 THEN 20 WHEN {_ANGLE} < 25 THEN 60 WHEN {_ANGLE} < 50 THEN 20 "
           "ELSE 3 END + CASE WHEN h % 40 <> 3 AND cents % 1001 >= 800 THEN 15 ELSE 0 END")
_HIT = f"(h % 199 <> 7 AND (h * 17) % 100 < {_CHANCE})"

DERIVED = {
    "events": (f"CASE WHEN h % 199 = 7 THEN NULL WHEN NOT {_HIT} THEN 'field_out' WHEN h % 10 < 6 THEN 'single' "
               "WHEN h % 10 < 8 THEN 'double' WHEN h % 10 = 8 THEN 'triple' ELSE 'home_run' END"),
    "bb_type": (f"CASE WHEN h % 5 = 0 THEN NULL WHEN {_ANGLE} < 10 THEN 'ground_ball' "
                f"WHEN {_ANGLE} < 25 THEN 'line_drive' WHEN {_ANGLE} < 50 THEN 'fly_ball' ELSE 'popup' END"),
    "zone": "CAST(1 + h % 14 AS STRING)",
    "plate_x": "CASE WHEN h % 60 = 2 THEN NULL ELSE CAST((h * 7) % 1001 - 500 AS DOUBLE) / 100 END",
    "plate_z": "CASE WHEN h % 60 = 2 THEN NULL ELSE CAST((h * 11) % 601 AS DOUBLE) / 100 END",
    "stand": "CASE WHEN h % 3 = 0 THEN 'L' ELSE 'R' END",
    "p_throws": "CASE WHEN l_suppkey % 4 = 0 THEN 'L' ELSE 'R' END",
    "launch_speed": "CASE WHEN h % 40 = 3 THEN NULL ELSE CAST(150 + cents % 1001 AS DOUBLE) / 10 END",
    "launch_angle": f"CASE WHEN h % 50 = 1 THEN NULL ELSE CAST({_ANGLE} AS DOUBLE) END",
    **{name: (f"CASE WHEN game_date < DATE '2023-07-14' OR h % 11 = {i} THEN NULL "
              f"ELSE CAST({start} + (h * {factor}) % {modulus} AS DOUBLE) / 10 END")
       for i, (name, (start, factor, modulus)) in enumerate(_SWING.items())},
    "hc_x": "CAST((h * 43) % 2501 AS DOUBLE) / 10",
    "hc_y": "CAST((h * 47) % 2501 AS DOUBLE) / 10",
    "hit_distance_sc": "CASE WHEN h % 20 = 4 THEN NULL ELSE CAST((h * 53) % 451 AS DOUBLE) END",
    # The stored label; a few are wrong, some of these on unknown outcomes.
    "stored_label": f"{_HIT} <> (h % 997 = 0 OR h % 1990 = 7)",
}

PITCH_COLUMNS = [c for c in EVENT_COLUMNS if c != "is_hit"]
_written: dict[tuple[str, str], str] = {}


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The few columns that order every pitch and give all others."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.selectExpr(*_SOURCE, *[f"{e} AS {n}" for n, e in BASE.items()])


def derived(df: DataFrame) -> DataFrame:
    """Pitches and their stored labels, from the columns of ``base``."""
    return df.selectExpr("*", *[f"{e} AS {n}" for n, e in DERIVED.items()])


def derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pitch and its stored label, with the source columns that order them."""
    return derived(base(spark, sf_dir))


def numbered(df: DataFrame) -> DataFrame:
    """Rows of ``base`` with their season and dense position in day order, dealt by ranges of it. What is derived from them is better derived afterwards: it need not be shuffled."""
    # Order keys of one day are cut into cells, so that a day of any size is numbered by many tasks.
    cells = ["season", "game_date", F.shiftright(F.col("l_orderkey"), 20)]
    return ordered_index(df.withColumn("season", F.year("game_date")), "pitch_id", cells, [F.col(c) for c in ORDER if c != "game_date"])


def laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbered pitches as the feed stores them: dealt by ranges of the key, in order.

    The one shuffle, that of the numbering, carries the columns of the source alone; the feed's own, four times as wide, are derived
    behind it. The season rises with the key; as the first level it is the order that a partitioned write asks for, so that the write does not sort again.
    """
    rows = derived(numbered(base(spark, sf_dir)))
    return rows.select("pitch_id", *PITCH_COLUMNS, F.col("stored_label").alias("is_hit"), "season")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbered pitches, derived once per session and kept as a table in the shared folder.

    One directory per season; inside, files follow the day order, so that a day filter skips files by
    their statistics. Ranges of the dense key split a heavy day over several files.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        path = f"{shared_folder(spark)}/inplay-feed-{uuid.uuid4().hex}"
        laid_out(spark, sf_dir).write.partitionBy("season").parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])


def pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing feed: one row per pitch, without a key."""
    return feed(spark, sf_dir).select(*PITCH_COLUMNS)


def batted_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table, with its key."""
    stored = feed(spark, sf_dir).where(F.col("bb_type").isNotNull())
    return stored.withColumnRenamed("pitch_id", KEY_COLUMN).select(KEY_COLUMN, *EVENT_COLUMNS)


def sql_tables() -> str:
    """The feed and the table as SQL common table expressions ``pitches`` and ``batted_ball_events``."""
    base = ", ".join(f"{e} AS {n}" for n, e in BASE.items())
    derived = ", ".join(f"{e} AS {n}" for n, e in DERIVED.items())
    return (
        f"base AS (SELECT {', '.join(_SOURCE)}, {base} FROM lineitem),\n"
        f"pitches AS (SELECT *, {derived}, row_number() OVER (ORDER BY {', '.join(ORDER)}) AS pitch_id FROM base),\n"
        f"batted_ball_events AS (SELECT pitch_id AS {KEY_COLUMN}, stored_label AS is_hit, "
        f"{', '.join(c for c in EVENT_COLUMNS if c != 'is_hit')} FROM pitches WHERE bb_type IS NOT NULL)"
    )
