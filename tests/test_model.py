import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from inplay.functions import (
    display_name, label_text, percent_text, round_half_even, sign_label, thousands,
)
from inplay.operators import metrics, profile, split
from inplay.operators.checks import ExpectationError
from inplay.operators.features import TablePreprocessor, TablePreprocessorModel, learn_levels, numeric_summary
from inplay.operators.model import (
    TableClassifier, coefficient_impact, coefficients, score, score_by_transform,
)
from inplay.plans import catalog, experiments
from inplay.schema import CATEGORICAL, CONTACT_NUMERIC, LABEL_COLUMN, SWING_NUMERIC

REFERENCE = {"kind": "a"}


def small(spark, rows):
    return spark.createDataFrame(rows, "x double, kind string, is_hit boolean")


def fit_small(df):
    return TablePreprocessor(numericCols=["x"], categoricalCols=["kind"], references=REFERENCE).fit(df)


def test_imputation_scaling_and_encoding(spark):
    train = small(spark, [(1.0, "b", True), (2.0, "a", False), (None, "b", True), (9.0, None, False), (4.0, "a", True)])
    model = fit_small(train)
    filled = np.array([1.0, 2.0, 3.0, 9.0, 4.0])
    learned = model.getOrDefault("summary")["x"]
    assert learned["median"] == 3.0
    assert learned["mean"] == pytest.approx(filled.mean(), abs=1e-14)
    assert learned["scale"] == pytest.approx(filled.std(), abs=1e-14)
    # Equal counts: the smallest level is the mode. Levels are sorted, and the reference one is dropped.
    assert model.getOrDefault("learned")["kind"] == {"levels": ["a", "b"], "mode": "a"}
    assert model.feature_names == ["numeric__x", "categorical__kind_b"]
    rows = small(spark, [(None, None, True), (float("nan"), "never seen", True), (3.0, "b", True)])
    got = [list(r["features"]) for r in model.transform(rows).collect()]
    z = (3.0 - filled.mean()) / filled.std()
    assert np.allclose(got, [[z, 0.0], [z, 0.0], [z, 1.0]], atol=1e-12)


def test_constant_column_is_not_divided_by_zero(spark):
    model = fit_small(small(spark, [(5.0, "a", True), (5.0, "a", False)]))
    assert model.getOrDefault("summary")["x"]["scale"] == 1.0


def test_missing_reference_level_and_empty_column(spark):
    with pytest.raises(ExpectationError, match="reference level"):
        fit_small(small(spark, [(1.0, "b", True)]))
    with pytest.warns(UserWarning, match="no training values"):
        model = fit_small(small(spark, [(None, "a", True), (None, "b", True)]))
    assert model.feature_names == ["categorical__kind_b"]


def test_no_rows_raise(spark, extract):
    with pytest.raises(ExpectationError, match="no training rows"):
        fit_small(small(spark, []))
    with pytest.raises(ExpectationError, match="test split"):
        experiments.baseline_experiment(extract.where("game_date < DATE '2025-01-01'"))


def test_any_number_of_levels_is_learnt(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") > 1, F.col("id")).otherwise(5).cast("string").alias("kind"))
    learnt = learn_levels(rows, ["kind"])["kind"]
    assert learnt["mode"] == "5" and learnt["levels"] == sorted({str(i) for i in range(2, 20_000)})


def test_nan_is_missing_and_a_constant_column_is_not_scaled(spark):
    rows = [(0.1, float("nan"))] * 700 + [(None, 3.0)] + [(0.1, 5.0)] * 300
    _, summary = numeric_summary(spark.createDataFrame(rows, "x double, y double"), ["x", "y"])
    assert summary["x"] == {"median": 0.1, "mean": 0.1, "scale": 1.0}
    assert summary["y"]["median"] == 5.0 and 0 < summary["y"]["scale"] < 1
    model = fit_small(small(spark, [(float("nan"), "b", True), (2.0, "a", False), (4.0, "b", True)]))
    assert model.feature_names[-1] == "categorical__kind_b"


def test_preprocessor_can_be_saved(spark, tmp_path):
    model = fit_small(small(spark, [(1.0, "b", True), (2.0, "a", False)]))
    model.write().overwrite().save(str(tmp_path / "m"))
    again = TablePreprocessorModel.load(str(tmp_path / "m"))
    assert again.feature_names == model.feature_names
    assert again.getOrDefault("summary") == model.getOrDefault("summary")


def newton(x, y, strength=1.0):
    x = np.c_[np.ones(len(x)), x]
    penalty = np.ones(x.shape[1])
    penalty[0] = 0.0
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = strength * x.T @ (p - y) + penalty * w
        hessian = strength * (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-12:
            break
    return w


@pytest.fixture(scope="module")
def extract(spark, sf):
    return catalog._extract(spark, sf).persist()


@pytest.fixture(scope="module")
def baseline(extract):
    return experiments.baseline_experiment(extract)


def test_fit_is_the_penalised_optimum(extract, baseline):
    train, _ = split.time_split(extract)
    prepared, regression = baseline.model.stages
    encoded = prepared.encoded()
    pdf = train.select(*[e.alias(n) for n, e in encoded.items()], F.col(LABEL_COLUMN).cast("int").alias("y")).toPandas()
    w = newton(pdf[list(encoded)].to_numpy(), pdf["y"].to_numpy())
    assert regression.intercept == pytest.approx(w[0], abs=1e-5)
    assert np.allclose(regression.coefficients.toArray(), w[1:], atol=1e-5)
    z = pdf[[n for n in encoded if n.startswith("numeric")]]
    assert np.allclose(z.mean(), 0, atol=1e-9) and np.allclose(z.std(ddof=0), 1, atol=1e-9)


def test_both_ways_of_scoring_agree(extract, baseline):
    _, test = split.time_split(extract)
    a = score(baseline.model, test).agg(F.sum("p"), F.sum(F.col("p") * F.col("launch_speed"))).first()
    b = score_by_transform(baseline.model, test).agg(F.sum("p"), F.sum(F.col("p") * F.col("launch_speed"))).first()
    assert np.allclose(a, b, rtol=1e-12)


def test_fitted_model_can_be_saved(extract, baseline, tmp_path):
    baseline.model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    rows = extract.limit(20)
    assert np.allclose([r["p"] for r in score(again, rows).collect()],
                       [r["p"] for r in score(baseline.model, rows).collect()])


def test_coefficient_table(baseline):
    rows = {r["feature"]: r for r in coefficients(baseline.model).collect()}
    assert len(rows) == 9 and "categorical__bb_type_ground_ball" not in rows
    for r in rows.values():
        assert r["odds_ratio"] == pytest.approx(np.exp(r["coefficient"]))
    shown = {r["predictor"]: r["impact"] for r in coefficient_impact(baseline.model).collect()}
    assert shown["Line Drive"] == "positive" and shown["Popup"] == "negative"


def test_comparison_uses_the_same_rows(extract):
    result = experiments.compare(extract)
    rows = {r["model"]: r.asDict() for r in result.table.collect()}
    a, b, d = (rows[m] for m in (metrics.MODEL_A, metrics.MODEL_B, metrics.DIFFERENCE))
    assert a["observed_hit_rate"] == b["observed_hit_rate"]
    for c in metrics.METRICS:
        assert d[c] == pytest.approx(b[c] - a[c], abs=1e-12)
    # The shared preprocessing gives model A what fitting it alone would.
    train, _ = split.time_split(extract, experiments.TRACKING_WINDOW)
    alone = TableClassifier(numericCols=CONTACT_NUMERIC, categoricalCols=CATEGORICAL).fit(split.complete_cases(train))
    assert np.allclose(alone.stages[1].coefficients.toArray(), result.model_a.stages[1].coefficients.toArray(), atol=1e-6)
    assert len(result.model_b.stages[0].feature_names) == 16


def test_tracking_imputes_instead_of_dropping(extract):
    fitted = experiments.tracking_experiment(extract)
    train, test = split.time_split(extract, experiments.TRACKING_WINDOW)
    assert fitted.model.stages[0].n_rows == train.count()
    assert fitted.scored.where("p IS NULL").count() == 0 and fitted.scored.count() == test.count()
    assert [c for c in SWING_NUMERIC if f"numeric__{c}" not in fitted.model.stages[0].feature_names] == []


def test_sample_is_exact_and_repeatable(extract, spark):
    df = spark.range(5000).withColumnRenamed("id", "batted_ball_id")
    first = {r[0] for r in profile.sample_n(df).collect()}
    assert len(first) == 1000 and first == {r[0] for r in profile.sample_n(df.repartition(7)).collect()}
    assert first != {r[0] for r in profile.sample_n(df, seed=1).collect()}
    assert profile.sample_n(df.limit(10)).count() == 10


def test_text_and_rounding_helpers(spark):
    df = spark.createDataFrame([(0.0,), (2.5,), (-1.0,)], "x double")
    assert [r[0] for r in df.select(sign_label("x")).collect()] == ["negative", "positive", "negative"]
    assert [r[0] for r in df.select(round_half_even(F.col("x"), 0)).collect()] == [0.0, 2.0, -1.0]
    row = spark.range(1).select(
        thousands(F.lit(1234567)).alias("a"), percent_text(F.lit(0.31849)).alias("b"),
        percent_text(F.lit(0.31849), 2).alias("c"), label_text(F.lit(True)).alias("d"),
        label_text(F.lit(False)).alias("e"), label_text(F.lit(None).cast("boolean")).alias("f"),
        display_name(F.lit("numeric__plate_x")).alias("g"), display_name(F.lit("other")).alias("h")).first()
    assert tuple(row) == ("1,234,567", "31.8%", "31.85%", "Hit", "Non-Hit", None, "Plate X", "other")
