import threading
from datetime import date

import pytest
from test_ingest import frame, pitch

from inplay.operators import ingest
from inplay.plans.load import load_range, publish_range
from inplay.schema import EVENT_COLUMNS, KEY_COLUMN, TABLE_SCHEMA
from inplay.sources import published
from inplay.sources.jdbc import JdbcTable
from inplay.sources.published import ConcurrentLoad, PublishedTable


@pytest.fixture
def table(spark, tmp_path):
    return PublishedTable(spark, str(tmp_path / "events"))


def feed(spark, *days):
    return frame(spark, *(pitch(d, launch_speed=float(k)) for k, d in enumerate(days)))


def report_of(result):
    return {r["game_date"].day: (r["status"], r["loaded_rows"], r["change"]) for r in result.report.collect()}


def keys(table):
    return sorted(r[0] for r in table.read().select(KEY_COLUMN).collect())


def test_loads_are_idempotent_and_skip_stored_days(spark, table):
    assert table.read().schema == TABLE_SCHEMA and table.count() == 0 and table.last_key() == 0 and table.days().count() == 0
    rows = feed(spark, "2021-05-02", "2021-05-02", "2021-05-04")
    one = publish_range(rows, table, "2021-05-01", "2021-05-04")
    assert one.total_inserted == 3
    assert report_of(one) == {1: ("no rows", 0, 0), 2: ("loaded", 2, 2), 3: ("no rows", 0, 0), 4: ("loaded", 1, 1)}
    more = feed(spark, "2021-05-02", "2021-05-03", "2021-05-04", "2021-05-05", "2021-06-09")
    two = publish_range(more, table, "2021-05-02", "2021-05-05")
    assert two.total_inserted == 2
    assert report_of(two) == {2: ("already loaded", 0, 0), 3: ("loaded", 1, 1), 4: ("already loaded", 0, 0), 5: ("loaded", 1, 1)}
    assert publish_range(more, table, "2021-05-02", "2021-05-05").total_inserted == 0
    assert keys(table) == [1, 2, 3, 4, 5] and table.count() == 5 == table.read().count() and table.last_key() == 5
    assert {r[0] for r in table.days().collect()} == {date(2021, 5, d) for d in (2, 3, 4, 5)}
    assert publish_range(more, table, "2021-05-05", "2021-05-02").total_inserted == 0


def test_a_load_that_dies_before_publishing_leaves_nothing(spark, table, monkeypatch):
    rows = feed(spark, "2021-05-02", "2021-05-03")
    publish_range(rows, table, "2021-05-02", "2021-05-02")

    def dies(self, load, after):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(PublishedTable, "publish", dies)
        with pytest.raises(RuntimeError):
            publish_range(rows, table, "2021-05-01", "2021-05-03")
    assert table.count() == 1 and table.read().count() == 1 and len(table.loads()) == 1
    # The next load goes on with what was staged: no new directory of rows.
    staged = set(table._names(table._data()))
    assert publish_range(rows, table, "2021-05-01", "2021-05-03").total_inserted == 1
    assert set(table._names(table._data())) == staged and keys(table) == [1, 2]


def test_a_half_written_stage_is_not_read(spark, table):
    rows = feed(spark, "2021-05-02", "2021-05-03")
    load = table.stage(ingest.assign_keys(ingest.clean_batted_balls(rows)), "2021-05-01_2021-05-31_0")
    table._fs.delete(table._path(f"{table._data(load)}/_SUCCESS"), False)
    assert publish_range(rows, table, "2021-05-01", "2021-05-31").total_inserted == 2
    assert load not in table.loads() and keys(table) == [1, 2]
    assert table.vacuum() == [load] and table.vacuum() == [] and keys(table) == [1, 2]


def test_loads_at_once(spark, table, monkeypatch):
    """Both read the same manifests; the second to publish begins again and gets other keys."""
    staged = threading.Barrier(2, timeout=60)
    stage, waited = PublishedTable.stage, set()

    def meet(self, rows, label):
        load = stage(self, rows, label)
        if threading.get_ident() not in waited:
            waited.add(threading.get_ident())
            staged.wait()
        return load

    monkeypatch.setattr(PublishedTable, "stage", meet)
    rows, found = feed(spark, "2021-05-02", "2021-05-02", "2021-05-03"), []
    threads = [threading.Thread(target=lambda a=a, b=b: found.append(publish_range(rows, table, a, b).total_inserted))
               for a, b in (("2021-05-01", "2021-05-02"), ("2021-05-02", "2021-05-03"))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sum(found) == 3 and keys(table) == [1, 2, 3] and len(table.loads()) == 2


def test_a_stage_for_an_older_table_is_refused(spark, table):
    rows = feed(spark, "2021-05-02", "2021-05-03")
    before = table.loads()
    late = table.stage(ingest.assign_keys(ingest.clean_batted_balls(rows)), "late")
    publish_range(rows, table, "2021-05-02", "2021-05-02")
    with pytest.raises(ConcurrentLoad):
        table.publish(late, before)
    assert keys(table) == [1] and len(table.loads()) == 1


def test_stored_days_and_keys_need_no_data_file(spark, table):
    publish_range(feed(spark, "2021-05-02"), table, "2021-05-01", "2021-05-31")
    for df in (table.days(), table.manifest()):
        files = df.inputFiles()
        assert files and all("/published/" in f for f in files)


def test_load_into_any_table(spark):
    """A load takes whatever reads and appends; here a list of frames in place of a database."""
    class Frames:
        rows = spark.createDataFrame([], TABLE_SCHEMA)

        def read(self):
            return self.rows

        def last_key(self):
            return self.rows.agg({KEY_COLUMN: "max"}).first()[0] or 0

        def append(self, rows):
            self.rows = spark.createDataFrame(self.rows.union(rows.select(*TABLE_SCHEMA.names)).collect(), TABLE_SCHEMA)

    some = Frames()
    assert load_range(feed(spark, "2021-05-02", "2021-05-04"), some, "2021-05-01", "2021-05-03").total_inserted == 1
    assert load_range(feed(spark, "2021-05-02", "2021-05-04"), some, "2021-05-01", "2021-05-31").total_inserted == 1
    assert sorted(r[KEY_COLUMN] for r in some.rows.collect()) == [1, 2]


def test_database_table_reads_in_parallel_and_asks_for_its_last_key(spark, monkeypatch):
    asked, written = [], []

    class Reader:
        def first(self):
            return (7,)

    monkeypatch.setattr("inplay.sources.jdbc.read_table", lambda spark, options: asked.append(options) or Reader())
    monkeypatch.setattr("inplay.sources.jdbc.append_table", lambda rows, options: written.append((rows, options)))
    table = JdbcTable(spark, {"url": "jdbc:x", "dbtable": '"public"."events"'}, date(2021, 1, 1), date(2025, 12, 31), 16)
    table.read()
    assert asked[0]["numPartitions"] == "16" and asked[0]["partitionColumn"] == "game_date"
    assert table.last_key() == 7 and asked[1]["query"].endswith('FROM "public"."events"') and "dbtable" not in asked[1]
    table.append("rows")
    assert written == [("rows", {"url": "jdbc:x", "dbtable": '"public"."events"'})]


def test_columns_of_the_published_table(spark, table):
    publish_range(feed(spark, "2021-05-02"), table, "2021-05-02", "2021-05-02")
    assert table.read().columns == [KEY_COLUMN, *EVENT_COLUMNS] and published.MANIFEST_SCHEMA.names[-1] == "load"
