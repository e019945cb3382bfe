import math
import re
from collections import Counter

import pytest

from inplay.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def test_op7(spark, sf, docs):
    want = {r.doc_id: base(r.text) for r in docs.collect()}
    rows = queries.op7_quality_rules(spark, sf).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in rows} == want
    assert not any(r.kept for r in rows if r.base_failed)


def test_quality_odd(odd, spark):
    labels = spark.createDataFrame([(0, 1), (None, 1), (3, None), (3, 0), (99, 1)], "doc_id long, quality int")
    rows = quality.judged(odd, labels).collect()
    want = sorted(base(r.text) for r in odd.collect())
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == want
    assert all(r.kept == (not r.base_failed) for r in rows)
    assert quality.judged(odd.limit(0), labels).count() == 0


def binomial(k, n, p):
    return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))


@pytest.mark.parametrize("share", [0.01, 0.025])
def test_the_bound_is_exact(spark, share):
    F = quality.F
    cases = [(k, n) for n in (1, 50, 200, 900) for k in (0, 1, 2, 5, 9, 22, 300) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long")
    for level in (0.05, 0.001):
        got = {(r.k, r.n): r.ok for r in df.withColumn("ok", quality.few_enough(F.col("k"), F.col("n"), share, F.lit(level))).collect()}
        assert got == {(k, n): k < n * share and binomial(k, n, share) <= level for k, n in cases}


def test_cutoffs_follow_the_labels(spark):
    """Junk goes where labels suffice; a stratum with few labels, and one where good texts look like junk, keep theirs."""
    good, junk = "fine words here and there " + " ".join(f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz") + " ", " ".join(f"bad{c}***" for c in "abcdefghijklmnopqrstuvwxyz")
    rows, labels, i = [], [], 0
    for lang, n, good_junk in (("en", 400, 0), ("few", 30, 0), ("odd", 400, 100)):
        for k in range(n):
            rows.append((i, good + f"{lang}{i}" if k >= good_junk else junk, lang))
            labels.append((i, 1))
            rows.append((i + 100_000, junk, lang))
            i += 1
    found = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    lang = {r[0]: r[2] for r in rows}
    kept = Counter((lang[r.doc_id], r.doc_id >= 100_000, r.kept) for r in found.where("NOT base_failed").collect())
    assert kept["en", True, True] == 0 and kept["en", False, False] == 0
    assert kept["few", True, False] == 0 and kept["odd", False, False] == 0


def test_no_python_in_the_plan(spark, sf):
    plan = queries.op7_quality_rules(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
