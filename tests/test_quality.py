from datetime import date
from decimal import Decimal

import pytest

from inplay.operators import checks, extract, quality, split
from inplay.schema import EVENT_SCHEMA, EXTRACT_COLUMNS, TABLE_SCHEMA, Window


def event(day="2021-05-01", events="single", is_hit=True, key=1, **other):
    values = {c: None for c in TABLE_SCHEMA.names}
    values.update(batted_ball_id=key, game_date=date.fromisoformat(day), events=events, is_hit=is_hit,
                  bb_type="fly_ball", launch_speed=90.0, launch_angle=10.0)
    values.update(other)
    return tuple(values[c] for c in TABLE_SCHEMA.names)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), TABLE_SCHEMA)


def test_label_checks_ignore_unknown_outcomes(spark):
    df = frame(spark, event(events=None, is_hit=True), event(events="field_out", is_hit=True),
               event(events="double", is_hit=False), event(events=None, is_hit=False))
    assert quality.mislabeled_hits(df).first()[0] == 1
    assert quality.missed_hits(df).first()[0] == 1
    assert tuple(quality.label_consistency(df).first()) == (1, 1)


def test_rates_round_exact_ties_up(spark):
    # 1 / 32 = 0.03125 and 1 / 800 of nulls = 0.125 percent: both are ties.
    rows = [event(is_hit=i == 0) for i in range(32)]
    got = quality.rate_by(frame(spark, *rows), "year")
    assert got.schema["bbe_hit_rate"].dataType.simpleString() == "decimal(5,4)"
    assert got.first()["bbe_hit_rate"] == Decimal("0.0313")
    rows = [event(events=None if i == 0 else "single") for i in range(800)]
    assert quality.null_profile_core(frame(spark, *rows)).first()["percent_null_events"] == Decimal("0.13")


def test_range_profile_of_nothing_and_of_nulls(spark):
    empty = quality.range_profile(frame(spark)).first()
    assert empty["total_rows"] == 0 and empty["percent_launch_speed_below_20mph"] is None
    row = quality.range_profile(frame(spark, event(launch_speed=None), event(launch_speed=19.9))).first()
    assert row["percent_launch_speed_below_20mph"] == 50.0


def test_grain_is_checked(spark):
    with pytest.raises(ValueError):
        quality.counts_by(frame(spark), "week")


def passed(report):
    return {r["check"]: r["passed"] for r in report.collect()}


def test_expectations_pass_and_fail(spark):
    good = frame(spark, event(key=1), event(key=2))
    assert all(passed(checks.validate(good, checks.table_expectations())).values())
    assert all(passed(checks.validate(good, checks.extract_expectations(), strict=True)).values())
    loose = spark.createDataFrame(
        [(1, None, None), (1, True, None), (None, False, "x")], "batted_ball_id long, is_hit boolean, bb_type string")
    report = passed(checks.validate(loose, [
        *checks.not_null("is_hit", "bb_type", "batted_ball_id"), checks.unique("batted_ball_id")]))
    assert report == {"is_hit_not_null": False, "bb_type_not_null": False, "batted_ball_id_not_null": False,
                      "batted_ball_id_unique": False}
    with pytest.raises(checks.ExpectationError, match="not_empty"):
        checks.validate(frame(spark), checks.extract_expectations(), strict=True)
    numbers = spark.createDataFrame([(0,), (1,), (2,)], "is_hit int")
    assert passed(checks.validate(numbers, [checks.binary("is_hit")])) == {"is_hit_binary": False}
    assert passed(checks.validate(numbers.where("is_hit < 2"), [checks.binary("is_hit")])) == {"is_hit_binary": True}
    assert passed(checks.validate(loose, [checks.no_nulls(["is_hit", "bb_type"])])) == {"no_nulls": False}


def test_same_rows(spark):
    a, b = frame(spark, event(key=1), event(key=2)), frame(spark, event(key=2), event(key=3))
    assert passed(checks.same_rows(a, a)) == {"same_rows": True}
    assert passed(checks.same_rows(a, b)) == {"same_rows": False}


def test_schema_checks(spark):
    df = frame(spark)
    checks.require_columns(df.columns)
    with pytest.raises(checks.ExpectationError, match="bat_speed"):
        checks.require_columns([c for c in df.columns if c != "bat_speed"])
    checks.require_feature_schema(df, df, ["plate_x"], ["stand"])
    for numeric, categorical, other in [(["is_hit"], [], df), (["stand"], [], df), ([], ["plate_x"], df),
                                        (["plate_x"], [], df.drop("plate_x"))]:
        with pytest.raises(checks.ExpectationError):
            checks.require_feature_schema(df, other, numeric, categorical)
    checks.require_references(["stand"], {"stand": "R"})
    with pytest.raises(checks.ExpectationError):
        checks.require_references(["stand", "bb_type"], {"stand": "R"})
    with pytest.raises(checks.ExpectationError):
        checks.require_binary_type(df, "stand")


def test_extract_rules(spark):
    df = frame(spark, event("2021-04-01", key=1), event("2021-03-31", key=2), event("2021-10-03", key=3),
               event("2021-10-04", key=4), event("2024-09-30", key=5, launch_angle=None))
    kept = extract.modeling_extract(df)
    assert kept.columns == EXTRACT_COLUMNS
    assert sorted(r[0] for r in kept.collect()) == [1, 3]
    seasons = extract.semi_join_seasons(df, extract.season_calendar(spark)).collect()
    assert sorted(r[0] for r in seasons) == [1, 3, 5]
    # An interval over new year is found from both years.
    winter = extract.season_calendar(spark, [(2021, "2021-10-01", "2022-02-01")])
    late = frame(spark, event("2021-10-01", key=1), event("2022-02-01", key=2), event("2022-02-02", key=3))
    assert sorted(r[0] for r in extract.semi_join_seasons(late, winter).collect()) == [1, 2]


def test_view_can_be_created_again(spark):
    frame(spark, event()).createOrReplaceTempView("some_events")
    for _ in range(2):
        view = extract.create_view(spark, "some_events", "some_extract")
    assert extract.load_modeling_extract(view).count() == 1
    frame(spark).createOrReplaceTempView("some_events")
    with pytest.raises(checks.ExpectationError):
        extract.load_modeling_extract(extract.create_view(spark, "some_events", "some_extract"))
    assert extract.quoted("a.odd `name") == "`a`.`odd ``name`"


def test_split_drops_gap_and_early_rows(spark):
    window = Window("2021-01-01", "2021-06-30", "2021-08-01")
    days = ["2020-12-31", "2021-01-01", "2021-06-30", "2021-07-15", "2021-08-01"]
    df = frame(spark, *[event(d, key=i) for i, d in enumerate(days)])
    train, test = split.time_split(df, window, require_rows=True)
    assert sorted(r[0] for r in train.collect()) == [1, 2]
    assert [r[0] for r in test.collect()] == [4]
    tagged = {r["batted_ball_id"]: r["split"] for r in split.with_split(df, window).collect()}
    assert tagged == {1: "train", 2: "train", 4: "test"}
    with pytest.raises(checks.ExpectationError):
        split.time_split(df, Window("2021-02-01", "2021-01-01", "2021-08-01"))
    with pytest.raises(checks.ExpectationError):
        split.time_split(df, Window("2021-01-01", "2021-08-01", "2021-08-01"))
    with pytest.raises(checks.ExpectationError):
        split.time_split(df, Window("2019-01-01", "2019-08-01", "2021-08-01"), require_rows=True)


def test_bad_dates_raise(spark):
    df = spark.createDataFrame([("2021-13-01",)], "game_date string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        split.time_split(df)[0].collect()


def test_schema_constants():
    assert len(EVENT_SCHEMA) == 21 and len(TABLE_SCHEMA) == 22 and len(EXTRACT_COLUMNS) == 17
