"""Every registered query: the operators applied to the derived feed and table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from inplay.functions import display_name, hit_label, label_text, season, threshold_label
from inplay.operators import checks, extract, features, ingest, intervals, metrics, profile, quality, split
from inplay.operators.model import coefficient_impact, coefficients, score_by_transform
from inplay.plans import experiments
from inplay.plans.load import publish_range, rows_to_load
from inplay.schema import (
    CATEGORICAL, CONTACT_NUMERIC, DATE_COLUMN, EXTRACT_COLUMNS, KEY_COLUMN, LABEL_COLUMN, MODEL_B_FEATURES, REFERENCE_LEVELS, SAMPLE_SEED,
    SWING_NUMERIC, TRACKING_WINDOW,
)
from inplay.sources import sample_feed
from inplay.session import shared_folder
from inplay.sources.landing import scan_days
from inplay.sources.published import PublishedTable

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

# The load queries act on a table that holds every day before this one.
STORED_BEFORE = "2025-01-01"
LOAD_RANGE = ("2021-01-01", "2025-12-31")
# Two loads that overlap.
ROUND_TRIP = [("2021-01-01", "2024-06-30"), ("2024-01-01", "2025-12-31")]
SCAN_RANGE = ("2021-04-01", "2021-10-03")
# Scores by plain arithmetic, so that ranking metrics can be checked without a fitted model.
SCORE_A = ("least(1e0, greatest(0e0, (launch_speed - 15e0) / 130e0 + CASE bb_type WHEN 'line_drive' THEN 25e-2 "
           "WHEN 'popup' THEN -3e-1 ELSE 0e0 END))")
SCORE_B = (f"least(1e0, greatest(0e0, {SCORE_A} + (bat_speed - 70e0) / 400e0))")
NUMERIC_B = CONTACT_NUMERIC + SWING_NUMERIC
# Where the curve of a fitted model is read.
ROC_THRESHOLDS = [k / 10 for k in range(1, 10)]


def register(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results of engines with other decimal types compare."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    """Doubles rounded: the last digits of a sum depend on the order of its terms."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _table(spark, sf):
    return sample_feed.batted_balls(spark, sf)


def _extract(spark, sf):
    return extract.modeling_extract(_table(spark, sf))


# ---- scans, cleaning, loading


@register
def scan_date_range(spark, sf):
    return scan_days(sample_feed.pitches(spark, sf), *SCAN_RANGE)


@register
def clean_batted_balls(spark, sf):
    return ingest.clean_batted_balls(sample_feed.pitches(spark, sf))


@register
def derive_label(spark, sf):
    labelled = sample_feed.pitches(spark, sf).withColumn(LABEL_COLUMN, hit_label("events"))
    return labelled.groupBy("events", LABEL_COLUMN).agg(F.count("*").alias("observations"))


@register
def date_spine(spark, sf):
    bounds = quality.date_range(_table(spark, sf))
    return ingest.spine_between(bounds, "date_of_first_record", "date_of_last_record")


def _stored(spark, sf):
    return _table(spark, sf).where(F.col(DATE_COLUMN) < F.lit(STORED_BEFORE).cast("date"))


@register
def unloaded_days(spark, sf):
    """Days of the load range that would be appended, with their rows."""
    new = rows_to_load(sample_feed.pitches(spark, sf), _stored(spark, sf), *LOAD_RANGE)
    return quality.counts_by(new, "day")


@register
def incremental_load(spark, sf):
    return rows_to_load(sample_feed.pitches(spark, sf), _stored(spark, sf), *LOAD_RANGE)


def _report(spark, sf):
    incoming = ingest.clean_batted_balls(scan_days(sample_feed.pitches(spark, sf), *LOAD_RANGE))
    return ingest.load_report(_stored(spark, sf), incoming, *LOAD_RANGE)


@register
def load_report(spark, sf):
    return _report(spark, sf)


@register
def load_total(spark, sf):
    return ingest.load_total(_report(spark, sf))


@register
def load_round_trip(spark, sf):
    """Two overlapping loads and a repeated one into a published table, beside a stage that was never published: what each day got.

    ``observations`` counts the rows that the table gives back; the rest comes from its manifests.
    """
    pitches = sample_feed.pitches(spark, sf)
    table = PublishedTable(spark, f"{shared_folder(spark)}/inplay-published-{uuid.uuid4().hex}")
    table.stage(ingest.assign_keys(ingest.clean_batted_balls(scan_days(pitches, *ROUND_TRIP[1]))), "left by a load that died")
    done = [publish_range(pitches, table, *days) for days in (*ROUND_TRIP, ROUND_TRIP[1])]
    # The third load changed nothing, so each day's change is that of the load that brought it.
    reports = [r.report.select(DATE_COLUMN, F.lit(k + 1).alias("load_number"), "change") for k, r in enumerate(done)]
    changed = reports[0].union(reports[1]).union(reports[2]).where("change <> 0").groupBy(DATE_COLUMN).agg(
        F.min("load_number").alias("load_number"), F.sum("change").alias("change"))
    read = table.read().groupBy(DATE_COLUMN).agg(F.count("*").alias("observations"), F.count_distinct(KEY_COLUMN).alias("keys"))
    return read.join(table.manifest().drop("load", "rows"), DATE_COLUMN).join(changed, DATE_COLUMN).select(
        DATE_COLUMN, "load_number", "change", "observations", "keys", "first_key", "last_key")


@register
def published_unloaded_days(spark, sf):
    """Days and rows that a load would add to a published table, whose stored days come from its manifests."""
    pitches = sample_feed.pitches(spark, sf)
    table = PublishedTable(spark, f"{shared_folder(spark)}/inplay-published-{uuid.uuid4().hex}")
    publish_range(pitches, table, *ROUND_TRIP[0])
    new = ingest.unloaded(ingest.clean_batted_balls(scan_days(pitches, *LOAD_RANGE)), table.days())
    return quality.counts_by(new, "day")


@register
def surrogate_key(spark, sf):
    """The dense key of every pitch, next to values that identify the pitch."""
    return sample_feed.derived(sample_feed.numbered(sample_feed.base(spark, sf))).select(
        "pitch_id", DATE_COLUMN, "launch_speed", "plate_x", "hc_x", "hc_y")


@register
def assigned_keys(spark, sf):
    """Keys given by a load, as the range each day received."""
    keyed = ingest.assign_keys(ingest.clean_batted_balls(sample_feed.pitches(spark, sf)), after=1000)
    return keyed.groupBy(DATE_COLUMN).agg(
        F.count("*").alias("observations"), F.min(KEY_COLUMN).alias("first_key"), F.max(KEY_COLUMN).alias("last_key"))


# ---- data-quality report


@register
def qa_total(spark, sf):
    return quality.total_rows(_table(spark, sf))


@register
def qa_date_range(spark, sf):
    return quality.date_range(_table(spark, sf))


@register
def qa_daily(spark, sf):
    return quality.counts_by(_table(spark, sf), "day").orderBy(DATE_COLUMN)


@register
def qa_monthly(spark, sf):
    return quality.counts_by(_table(spark, sf), "month").orderBy("year_month")


@register
def qa_yearly(spark, sf):
    return quality.counts_by(_table(spark, sf), "year").orderBy("season")


@register
def qa_days(spark, sf):
    return quality.distinct_days(_table(spark, sf))


@register
def qa_days_by_year(spark, sf):
    return quality.distinct_days_by_year(_table(spark, sf)).orderBy("season")


@register
def qa_hit_rate_daily(spark, sf):
    return plain(quality.rate_by(_table(spark, sf), "day")).orderBy(DATE_COLUMN)


@register
def qa_hit_rate_monthly(spark, sf):
    return plain(quality.rate_by(_table(spark, sf), "month")).orderBy("year_month")


@register
def qa_hit_rate_yearly(spark, sf):
    return plain(quality.rate_by(_table(spark, sf), "year")).orderBy("season")


@register
def qa_null_core(spark, sf):
    return plain(quality.null_profile_core(_table(spark, sf))).orderBy("season")


@register
def qa_null_tracking(spark, sf):
    return plain(quality.null_profile_swing(_table(spark, sf))).orderBy("season")


@register
def qa_ranges(spark, sf):
    return rounded(quality.range_profile(_table(spark, sf)))


@register
def qa_mislabeled(spark, sf):
    return quality.mislabeled_hits(_table(spark, sf))


@register
def qa_missed(spark, sf):
    return quality.missed_hits(_table(spark, sf))


@register
def qa_label_consistency(spark, sf):
    return quality.label_consistency(_table(spark, sf))


@register
def null_counts(spark, sf):
    return quality.null_counts(_extract(spark, sf))


def _other_events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("ts").cast("date").alias("day"), (F.col("event_type") == "purchase").alias("bought"))


@register
def other_table_daily(spark, sf):
    """The day counts on a table with another schema."""
    return quality.counts_by(_other_events(spark, sf), "day", "day")


@register
def other_table_monthly_rate(spark, sf):
    """The label rate on a table with another schema."""
    return plain(quality.rate_by(_other_events(spark, sf), "month", "bought", "day"))


# ---- modeling extract


@register
def modeling_extract(spark, sf):
    return _extract(spark, sf)


@register
def load_modeling_extract(spark, sf):
    """The extract through its view, validated."""
    _table(spark, sf).createOrReplaceTempView("batted_ball_events")
    view = extract.create_view(spark, "batted_ball_events")
    return extract.load_modeling_extract(view)


@register
def season_semi_join(spark, sf):
    inside = extract.semi_join_seasons(_table(spark, sf), extract.season_calendar(spark))
    return inside.where(extract.measured()).select(
        DATE_COLUMN, "events", LABEL_COLUMN, "bb_type", "launch_speed", "launch_angle", "hc_x", "hc_y")


@register
def interval_semi_join(spark, sf):
    """Events that fall into a span that begins with an error: up to four minutes long, and a day long for some users."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    spans = events.where("event_type = 'error'").selectExpr(
        "ts AS span_start", "ts + make_dt_interval(CASE WHEN user_id % 50 = 0 THEN 1 ELSE 0 END, 0, 0, event_id * 37 % 240) AS span_end")
    return intervals.interval_semi_join(events, "ts", spans, "span_start", "span_end").select("event_id", "user_id", "event_type")


@register
def validate_schema(spark, sf):
    """Schema expectations on the splits of the tracking window, and on splits that break each of them."""
    tagged = split.with_split(_extract(spark, sf), TRACKING_WINDOW)
    train, test = (tagged.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    window = [date.fromisoformat(d) for d in (TRACKING_WINDOW.train_start, TRACKING_WINDOW.train_end, TRACKING_WINDOW.test_start)]
    good = checks.schema_report(train, test, EXTRACT_COLUMNS, NUMERIC_B, CATEGORICAL, REFERENCE_LEVELS, window)
    broken = train.drop("stand").withColumn("bat_speed", F.col("bat_speed").cast("string")).withColumn(
        LABEL_COLUMN, F.when(F.col("launch_angle") != 0, F.col(LABEL_COLUMN)))
    bad = checks.schema_report(broken, test, EXTRACT_COLUMNS, [*NUMERIC_B, "p_throws"], ["bb_type", "stand", LABEL_COLUMN, "launch_speed"], ["bb_type", "stand"], window[::-1])
    return good.withColumn("case", F.lit("as it is")).unionByName(bad.withColumn("case", F.lit("broken")))


@register
def extract_check(spark, sf):
    """Rows and dates of the filtered table against those of the view, from one scan each."""
    table = _table(spark, sf)
    inside = extract.in_seasons(table) & extract.measured()
    bounds = [F.count("*").alias("n"), F.min(DATE_COLUMN).alias("a"), F.max(DATE_COLUMN).alias("b")]
    sides = (table.where(inside).agg(*bounds).withColumn("side", F.lit("table"))
             .unionByName(_extract(spark, sf).agg(*bounds).withColumn("side", F.lit("view"))))

    def of(side, c):
        return F.max(F.when(F.col("side") == side, F.col(c)))

    return sides.agg(
        of("table", "n").alias("table_rows"), of("view", "n").alias("view_rows"),
        of("table", "a").alias("first_date"), of("table", "b").alias("last_date"),
        ((of("table", "n") == of("view", "n")) & (of("table", "a") == of("view", "a"))
         & (of("table", "b") == of("view", "b"))).alias("same"))


@register
def pull_profile(spark, sf):
    return rounded(profile.pull_profile(ingest.clean_batted_balls(sample_feed.pitches(spark, sf))))


@register
def pull_distinct_events(spark, sf):
    return profile.distinct_values(ingest.clean_batted_balls(sample_feed.pitches(spark, sf)), "events")


@register
def pull_distinct_bb_types(spark, sf):
    return profile.distinct_values(ingest.clean_batted_balls(sample_feed.pitches(spark, sf)), "bb_type")


@register
def extract_profile(spark, sf):
    return profile.extract_profile(_extract(spark, sf))


@register
def extract_distinct_years(spark, sf):
    return profile.distinct_values(_extract(spark, sf), season(DATE_COLUMN).alias("season"))


@register
def label_value_counts(spark, sf):
    return profile.value_counts(_extract(spark, sf))


@register
def label_text_counts(spark, sf):
    return _extract(spark, sf).groupBy(LABEL_COLUMN, label_text(LABEL_COLUMN).alias("label")).agg(
        F.count("*").alias("observations"))


@register
def head_tail(spark, sf):
    return profile.head_tail(_extract(spark, sf))


# A multiplicative hash that other engines can compute as well.
SAMPLE_DRAW = f"(({KEY_COLUMN} + {SAMPLE_SEED} * 7919) % 2147483647) * 48271 % 2147483647"


@register
def sample_n(spark, sf):
    df = profile.sample_n(_extract(spark, sf), draw=F.expr(SAMPLE_DRAW))
    return df.select(KEY_COLUMN, "launch_angle", "launch_speed", label_text(LABEL_COLUMN).alias("label"))


@register
def hit_rate_by_type(spark, sf):
    return rounded(profile.label_rate_by(_extract(spark, sf)))


@register
def validate_extract(spark, sf):
    return checks.validate(_extract(spark, sf), checks.extract_expectations())


@register
def validate_not_null(spark, sf):
    return checks.validate(_table(spark, sf), checks.table_expectations())


@register
def validate_complete(spark, sf):
    """No nulls after, but some before, the complete-case rule."""
    df = split.with_split(_extract(spark, sf), TRACKING_WINDOW)
    name = checks.no_nulls(MODEL_B_FEATURES)
    before = checks.validate(df, [name]).withColumn("rows", F.lit("all"))
    return before.unionByName(checks.validate(split.complete_cases(df), [name]).withColumn("rows", F.lit("complete")))


@register
def validate_same_rows(spark, sf):
    """Both models of the comparison are scored on the same keys."""
    scored = _scored(spark, sf)
    a = scored.where(F.col("p_a").isNotNull())
    b = scored.where(F.col("p_b").isNotNull())
    return checks.same_rows(a, b)


# ---- split


@register
def time_split(spark, sf):
    train, test = split.time_split(_extract(spark, sf))
    return (train.select(KEY_COLUMN, DATE_COLUMN, F.lit("train").alias("split"))
            .unionByName(test.select(KEY_COLUMN, DATE_COLUMN, F.lit("test").alias("split"))))


@register
def split_profile(spark, sf):
    return split.split_profile(split.with_split(_extract(spark, sf)))


@register
def split_disjoint(spark, sf):
    """Keys in both splits: none."""
    train, test = split.time_split(_extract(spark, sf))
    both = train.select(KEY_COLUMN).intersect(test.select(KEY_COLUMN))
    return both.agg(F.count("*").alias("common_keys"))


@register
def complete_cases(spark, sf):
    df = split.with_split(_extract(spark, sf), TRACKING_WINDOW)
    return split.complete_cases(df).select(KEY_COLUMN, "split", *MODEL_B_FEATURES)


@register
def row_loss(spark, sf):
    return split.row_loss(split.with_split(_extract(spark, sf), TRACKING_WINDOW))


# ---- features


def _prepared(spark, sf):
    """Preprocessing learned from the training rows of the tracking window, and the rows of both splits."""
    tagged = split.with_split(_extract(spark, sf), TRACKING_WINDOW)
    train = tagged.where("split = 'train'")
    fitted = features.TablePreprocessor(numericCols=NUMERIC_B, categoricalCols=CATEGORICAL).fit(train)
    return fitted, tagged


@register
def median_impute(spark, sf):
    fitted, tagged = _prepared(spark, sf)
    return tagged.select(KEY_COLUMN, "split", *[fitted.imputed(c).alias(c) for c in NUMERIC_B])


@register
def standardize(spark, sf):
    fitted, tagged = _prepared(spark, sf)
    return rounded(tagged.select(KEY_COLUMN, "split", *[fitted.scaled(c).alias(c) for c in NUMERIC_B]), 6)


@register
def mode_impute(spark, sf):
    """The mode of training pitches in place of missing types and outcomes, over all pitches."""
    columns = ["bb_type", "events", "stand"]
    tagged = split.with_split(sample_feed.pitches(spark, sf))
    train = tagged.where("split = 'train'")
    mode = features.modes(features.level_counts(train, columns))
    wide = mode.agg(*[F.max(F.when(F.col("column") == c, F.col("mode"))).alias(c) for c in columns]).first()
    filled = [F.coalesce(F.col(c), F.lit(wide[c])).alias(c) for c in columns]
    return tagged.groupBy("split", *filled).agg(F.count("*").alias("observations"))


@register
def one_hot(spark, sf):
    fitted, tagged = _prepared(spark, sf)
    indicators = {n: e for n, e in fitted.encoded().items() if n.startswith("categorical__")}
    return tagged.select(KEY_COLUMN, "split", *[e.alias(n) for n, e in indicators.items()])


@register
def feature_display_names(spark, sf):
    fitted, _ = _prepared(spark, sf)
    names = spark.range(1).select(F.explode(F.array(*map(F.lit, fitted.feature_names))).alias("feature"))
    return names.select("feature", display_name("feature").alias("predictor"))


# ---- metrics of arithmetic scores


def _scored(spark, sf):
    """Complete test rows of the tracking window with two arithmetic scores."""
    tagged = split.with_split(_extract(spark, sf), TRACKING_WINDOW)
    test = split.complete_cases(tagged.where("split = 'test'"))
    return test.select("*", F.expr(SCORE_A).alias("p_a"), F.expr(SCORE_B).alias("p_b"))


def _single_score(spark, sf):
    """Every row of the extract with the first score."""
    return _extract(spark, sf).select("bb_type", LABEL_COLUMN, F.expr(SCORE_A).alias("p"))


def _two_scores(spark, sf):
    return experiments.stack_scores(_scored(spark, sf))


@register
def threshold_predict(spark, sf):
    df = _single_score(spark, sf)
    return df.groupBy("bb_type", threshold_label("p").alias("at_threshold"),
                      threshold_label("p", strict=True).alias("above_half")).agg(F.count("*").alias("observations"))


@register
def roc_curve(spark, sf):
    return rounded(metrics.roc_curve(_single_score(spark, sf), "p", LABEL_COLUMN), 10)


@register
def roc_curve_pruned(spark, sf):
    return rounded(metrics.roc_curve(_single_score(spark, sf), "p", LABEL_COLUMN, drop_intermediate=True), 10)


@register
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(_single_score(spark, sf), "p", LABEL_COLUMN))


@register
def average_precision(spark, sf):
    return rounded(metrics.average_precision(_single_score(spark, sf), "p", LABEL_COLUMN))


@register
def evaluation(spark, sf):
    return rounded(metrics.evaluation(_two_scores(spark, sf), "p", LABEL_COLUMN, by=["model"]))


@register
def evaluation_strict(spark, sf):
    """Single-model report: decisions above one half, three decimals."""
    result = metrics.evaluation(_single_score(spark, sf), "p", LABEL_COLUMN, strict_decision=True)
    return experiments.rounded(result)


@register
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_single_score(spark, sf), "p", LABEL_COLUMN)


@register
def ab_table(spark, sf):
    table = metrics.evaluation(_two_scores(spark, sf), "p", LABEL_COLUMN, by=["model"])
    return rounded(metrics.with_difference(table))


@register
def ab_metric_diff(spark, sf):
    table = metrics.evaluation(_two_scores(spark, sf), "p", LABEL_COLUMN, by=["model"])
    return rounded(metrics.metric_difference(metrics.long_metrics(table)))


# ---- fitted models


@register
def fit_baseline(spark, sf):
    """Intercept and coefficients of the fitted baseline."""
    model = experiments.baseline_experiment(_extract(spark, sf)).model
    fitted = coefficients(model).select("feature", "coefficient")
    intercept = spark.range(1).select(F.lit("intercept").alias("feature"), F.lit(float(model.stages[-1].intercept)).alias("coefficient"))
    return rounded(fitted.union(intercept), 4)


@register
def score_test(spark, sf):
    """Mean probability of the fitted baseline over the test rows, through the fitted stages, by ball type and label."""
    fitted = experiments.baseline_experiment(_extract(spark, sf))
    _, test = split.time_split(_extract(spark, sf))
    scored = score_by_transform(fitted.model, test)
    return rounded(scored.groupBy("bb_type", LABEL_COLUMN).agg(F.count("*").alias("observations"), F.avg("p").alias("mean_p")), 4)


@register
def baseline_experiment(spark, sf):
    return experiments.rounded(experiments.baseline_experiment(_extract(spark, sf)).metrics)


@register
def tracking_experiment(spark, sf):
    return experiments.rounded(experiments.tracking_experiment(_extract(spark, sf)).metrics)


def _shown(fitted: DataFrame) -> DataFrame:
    """Coefficients as reports print them; solvers agree to about six digits."""
    return fitted.withColumns({"coefficient": F.round("coefficient", 4), "odds_ratio": F.round("odds_ratio", 3)})


@register
def fitted_coefficients(spark, sf):
    fitted = coefficients(experiments.baseline_experiment(_extract(spark, sf)).model)
    return _shown(fitted.orderBy(F.desc("coefficient")))


@register
def fitted_coefficient_impact(spark, sf):
    fitted = coefficient_impact(experiments.baseline_experiment(_extract(spark, sf)).model)
    return _shown(fitted.orderBy("coefficient"))


@register
def fitted_roc_curve(spark, sf):
    """The curve of the fitted baseline at fixed thresholds: what scores of at least so much reach."""
    scored = experiments.baseline_experiment(_extract(spark, sf)).scored
    points = metrics.roc_curve(scored, "p", LABEL_COLUMN)
    reached = F.filter(F.array(*map(F.lit, ROC_THRESHOLDS)), lambda t: F.col("threshold") >= t)
    at = points.select(F.explode(reached).alias("at_least"), "fpr", "tpr")
    return rounded(at.groupBy("at_least").agg(F.max("fpr").alias("fpr"), F.max("tpr").alias("tpr")))


@register
def fitted_confusion_matrix(spark, sf):
    scored = experiments.tracking_experiment(_extract(spark, sf)).scored
    return metrics.confusion_matrix(scored, "p", LABEL_COLUMN)


@register
def ab_comparison(spark, sf):
    return experiments.rounded(experiments.compare(_extract(spark, sf)).table)
