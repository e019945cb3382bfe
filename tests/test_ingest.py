from datetime import date
from types import SimpleNamespace

import datetime

import pytest
from pyspark.sql import functions as F

from inplay.operators import ingest
from inplay.plans.load import load_range
from inplay.schema import EVENT_COLUMNS, EVENT_SCHEMA, KEY_COLUMN, PITCH_SCHEMA, TABLE_SCHEMA
from inplay.session import shared_folder
from inplay.sources import sample_feed
from inplay.sources.jdbc import append_options, connection_options, partitioned_read
from inplay.sources.landing import scan_days, scan_pitches
from inplay.sources.table import EventTable


def pitch(day, bb_type="fly_ball", events="single", **other):
    values = {c: None for c in PITCH_SCHEMA.names}
    values.update(game_date=date.fromisoformat(day), bb_type=bb_type, events=events, **other)
    return tuple(values[c] for c in PITCH_SCHEMA.names)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), PITCH_SCHEMA)


def test_label_of_unknown_outcome_is_false(spark):
    df = ingest.clean_batted_balls(frame(
        spark, pitch("2021-05-01", events=None), pitch("2021-05-01", events="home_run"),
        pitch("2021-05-01", events="sac_fly"), pitch("2021-05-01", bb_type=None)))
    assert df.columns == EVENT_COLUMNS
    assert sorted((str(r["events"]), r["is_hit"]) for r in df.collect()) == [
        ("None", False), ("home_run", True), ("sac_fly", False)]


def test_nan_is_missing(spark):
    row = ingest.clean_batted_balls(frame(spark, pitch("2021-05-01", launch_speed=float("nan")))).first()
    assert row["launch_speed"] is None


def test_source_without_ball_type_is_empty(spark):
    df = ingest.clean_batted_balls(frame(spark, pitch("2021-05-01")).drop("bb_type"))
    assert df.columns == EVENT_COLUMNS and df.count() == 0


def test_source_without_another_column_raises(spark):
    with pytest.raises(Exception, match="zone"):
        ingest.clean_batted_balls(frame(spark, pitch("2021-05-01")).drop("zone"))


def test_column_order_is_checked(spark):
    df = spark.createDataFrame([], EVENT_SCHEMA)
    assert ingest.require_columns_exact(df, EVENT_COLUMNS) is df
    with pytest.raises(ValueError):
        ingest.require_columns_exact(df.select(*reversed(EVENT_COLUMNS)), EVENT_COLUMNS)


def test_spine(spark):
    days = [r[0].isoformat() for r in ingest.date_spine(spark, "2024-02-28", "2024-03-01").collect()]
    assert days == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert ingest.date_spine(spark, "2024-03-02", "2024-03-01").count() == 0
    with pytest.raises(ValueError):
        ingest.date_spine(spark, "2024-3-2x", "2024-03-01")


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_day_range_on_any_date_type(spark, kind):
    days = ["2021-04-30", "2021-05-01", "2021-05-03", "2021-05-04"]
    df = spark.createDataFrame([(d,) for d in days], "game_date string").withColumn(
        "game_date", F.col("game_date").cast(kind))
    assert scan_days(df, "2021-05-01", "2021-05-03").count() == 2


@pytest.mark.parametrize("format", ["parquet", "orc", "csv", "json"])
def test_formats(spark, tmp_path, format):
    path = str(tmp_path / "landing")
    frame(spark, pitch("2021-05-01"), pitch("2021-05-02"), pitch("2021-06-01")).write.format(format).save(path)
    schema = PITCH_SCHEMA if format in ("csv", "json") else None
    got = scan_pitches(spark, path, "2021-05-01", "2021-05-31", format=format, schema=schema)
    assert ingest.clean_batted_balls(got).count() == 2


@pytest.fixture
def table(spark, request):
    name = "t_" + "".join(ch if ch.isalnum() else "_" for ch in request.node.name)
    yield EventTable(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_load_is_idempotent_and_skips_partial_days(spark, table):
    first = frame(spark, pitch("2021-05-02", launch_speed=1.0))
    one = load_range(first, table, "2021-05-01", "2021-05-31")
    assert one.total_inserted == 1
    feed = frame(spark, pitch("2021-05-02", launch_speed=2.0), pitch("2021-05-02", launch_speed=3.0),
                 pitch("2021-05-04"), pitch("2021-05-04", events="double"), pitch("2021-05-04", bb_type=None),
                 pitch("2021-06-30"))
    result = load_range(feed, table, "2021-05-01", "2021-05-05")
    assert result.total_inserted == 2
    report = {r["game_date"].day: (r["status"], r["loaded_rows"]) for r in result.report.collect()}
    assert report == {1: ("no rows", 0), 2: ("already loaded", 0), 3: ("no rows", 0), 4: ("loaded", 2), 5: ("no rows", 0)}
    assert ingest.load_total(result.report).first()[0] == 2
    # Reports do not change with later loads.
    assert ingest.load_total(one.report).first()[0] == 1
    assert load_range(feed, table, "2021-05-01", "2021-05-05").total_inserted == 0
    assert table.count() == 3
    assert sorted(r[0] for r in table.read().select(KEY_COLUMN).collect()) == [1, 2, 3]
    assert table.has_day("2021-05-02") and not table.has_day("2021-05-03")
    assert [f.name for f in table.read().schema] == TABLE_SCHEMA.names
    assert [f.dataType for f in table.read().schema] == [f.dataType for f in TABLE_SCHEMA]


def test_load_of_an_empty_range(spark, table):
    result = load_range(frame(spark, pitch("2021-05-02")), table, "2021-05-05", "2021-05-01")
    assert result.total_inserted == 0 and result.report.count() == 0 and table.count() == 0


def test_heavy_day_is_split_over_files_and_quiet_days_are_not(spark, table, sf):
    day = F.when(F.col("h") % 3 == 0, F.lit("2021-05-02")).otherwise(
        F.concat(F.lit("2021-06-0"), F.col("h") % 9 + 1)).cast("date")
    rows = sample_feed.derive(spark, sf).withColumn("game_date", day)
    # A heavy day is split between the tasks that number its rows, so there have to be several, and its rows
    # must not be few enough to be broadcast.
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert load_range(rows, table, "2021-05-01", "2021-06-30").total_inserted == 4782
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    stored = spark.table(table.name)
    named = stored.select("game_date", F.input_file_name().alias("file")).distinct()
    files = {r["game_date"]: r["count"] for r in named.groupBy("game_date").count().collect()}
    heavy = files.pop(date(2021, 5, 2))
    assert heavy > 2 and heavy > max(files.values()), (heavy, files)


def test_shared_folder_follows_the_session(spark):
    def session(folder, master):
        return SimpleNamespace(conf={"spark.checkpoint.dir": folder} if folder else {},
                               sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("hdfs://host/work/", "yarn")) == "hdfs://host/work"
    with pytest.raises(ValueError):
        shared_folder(session(None, "yarn"))
    assert shared_folder(spark)


def test_keys_continue_in_day_order(spark):
    rows = [pitch(f"2021-05-{d:02d}", launch_speed=float(i)) for d in (3, 1, 2) for i in range(20)]
    # Equal rows get keys of their own.
    rows += [pitch("2021-05-02", launch_speed=5.0)] * 3
    keyed = ingest.assign_keys(ingest.clean_batted_balls(frame(spark, *rows)), after=100).collect()
    assert sorted(r[KEY_COLUMN] for r in keyed) == list(range(101, 101 + 63))
    days = [r["game_date"] for r in sorted(keyed, key=lambda r: r[KEY_COLUMN])]
    assert days == sorted(days)


def test_connection_options():
    settings = {"DB_NAME": "games", "DB_USER": "u", "DB_PASSWORD": "p"}
    options = connection_options(settings)
    assert options["url"] == "jdbc:postgresql://localhost:5432/games"
    assert options["dbtable"] == '"public"."batted_ball_events"'
    assert append_options(options)["batchsize"] == "5000"
    assert partitioned_read(options, date(2021, 1, 1), date(2021, 12, 31), 12)["numPartitions"] == "12"
    with pytest.raises(ValueError, match="DB_PASSWORD"):
        connection_options({"DB_NAME": "games", "DB_USER": "u"})


def test_timestamps_keep_the_last_day(spark):
    df = spark.sql("SELECT timestamp'2021-10-03 18:00:00' AS game_date UNION ALL SELECT timestamp'2021-10-04 01:00:00'")
    from inplay.operators import extract, quality

    assert df.where(extract.in_seasons(df)).count() == 1
    assert ingest.loaded_days(df, "2021-10-03", "2021-10-03").count() == 1
    assert quality.distinct_days(df.union(df)).first()[0] == 2
    assert [r[0] for r in ingest.load_report(df.limit(0), df, "2021-10-01", "2021-10-03").where("loaded_rows = 1").collect()] == [datetime.date(2021, 10, 3)]
