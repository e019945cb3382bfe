import sys
from pathlib import Path

import pytest

from inplay.llm import licenses, queries

sys.path.insert(0, str(Path(__file__).parent.parent))

from comparing import connect  # noqa: E402


def brute(rows, templates, threshold=0.8):
    def runs(text):
        words = licenses._words(text or "")
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    own = {n: runs(t) for n, t in templates.items()}
    return sorted((i, n, len(s & runs(t)) / len(s)) for i, t in rows for n, s in own.items() if len(s & runs(t)) >= threshold * len(s))


def test_op4(spark, sf, docs):
    got = sorted(map(tuple, queries.op4_license_scan(spark, sf).collect()))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], licenses.TEMPLATES) and got
    assert got == sorted(connect(sf).execute(licenses.oracle()).fetchall())


def test_edited_and_embedded(spark):
    rows = []
    for i, text in enumerate(licenses.TEMPLATES.values()):
        words = text.split()
        rows.append((4 * i, "some words before it " * i + "\n> " + text.upper().replace(" ", "  \n# ") + " and more after it " * 3))
        rows.append((4 * i + 1, " ".join([*words[:-1], "otherwise"])))
        rows.append((4 * i + 2, " ".join(["x", *words[1:]])))
        rows.append((4 * i + 3, " ".join(words[: len(words) // 2])))
    got = sorted(map(tuple, licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == brute(rows, licenses.TEMPLATES)
    assert len(got) >= len(licenses.TEMPLATES)


def test_licenses_odd(odd, spark):
    assert licenses.scan(odd).count() == 0 and licenses.scan(odd.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "Released under the MIT License.")] * 2, "doc_id long, text string")
    assert licenses.scan(twice).count() == 2


@pytest.mark.parametrize("text", ["too short", "ten words that have no telling word among them at all"])
def test_bad_templates_are_refused(spark, text):
    with pytest.raises(ValueError):
        licenses.scan(spark.createDataFrame([], "doc_id long, text string"), {"bad": text})


def test_no_python_in_the_plan(spark, sf):
    plan = queries.op4_license_scan(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
