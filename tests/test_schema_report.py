from datetime import date

import pytest

from inplay.operators import checks

COLUMNS = ["key", "x", "kind", "label"]
WINDOW = [date(2021, 1, 1), date(2021, 12, 31), date(2022, 1, 1)]


def frame(spark, label=True):
    return spark.createDataFrame([(1, 0.5, "a", True), (2, 0.7, "b", label)], "key long, x double, kind string, label boolean")


def report(train, test=None, columns=COLUMNS, numeric=("x",), categorical=("kind",), references=("kind",), window=WINDOW, **other):
    found = checks.schema_report(train, test if test is not None else train, columns, list(numeric), list(categorical), references, window,
                                 label="label", required=COLUMNS, forbidden=["key", "label"], **other)
    return {r["check"]: r["detail"] for r in found.collect() if not r["passed"]}


def test_all_pass(spark):
    assert report(frame(spark), strict=True) == {}


@pytest.mark.parametrize("broken, says", [
    (dict(columns=["x", "key", "kind", "label"]), {"column_order": "key, x"}),
    (dict(columns=[*COLUMNS, "more"]), {"column_order": "more"}),
    (dict(numeric=["x", "kind"]), {"numeric": "kind"}),
    (dict(categorical=["kind", "x"], references=["kind", "x"]), {"categorical": "x"}),
    (dict(references=[]), {"reference_levels": "kind"}),
    (dict(window=[WINDOW[0], WINDOW[1], WINDOW[1]]), {"window_order": "test_start"}),
    (dict(window=[WINDOW[1], WINDOW[0], WINDOW[2]]), {"window_order": "train_end"}),
    (dict(numeric=["x", "key"]), {"no_leakage": "key"}),
])
def test_each_can_fail(spark, broken, says):
    assert report(frame(spark), **broken) == says


def test_frames_that_differ(spark):
    train = frame(spark)
    assert report(train, train.selectExpr("key", "CAST(x AS float) AS x", "kind", "label")) == {"same_features": "x"}
    assert report(train, train.drop("kind")) == {"same_features": "kind"}
    assert report(train.drop("kind"))["required_columns"] == "kind"
    assert report(frame(spark, label=None)) == {"label_rows": "label 1"}
    with pytest.raises(checks.ExpectationError, match="label_rows: label 1"):
        report(frame(spark, label=None), strict=True)
