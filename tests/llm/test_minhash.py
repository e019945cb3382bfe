import random

import numpy as np
import pyarrow as pa
import pytest

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from near import classes, near_pairs, shingle_set  # noqa: E402

from inplay.llm import minhash, queries  # noqa: E402
from inplay.llm.common import Words  # noqa: E402
from inplay.llm.components import components  # noqa: E402


def expected(rows):
    sets = {r.doc_id: shingle_set(r.text) for r in rows}
    return classes(sets, near_pairs(sets))


def test_op9(spark, sf, docs):
    want = expected(docs.collect())
    assert {r.doc_id: r.class_id for r in queries.op9_minhash(spark, sf).collect()} == want
    assert len(set(want.values())) < len(want)


def edited(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"x{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("block", [1024, 7])
def test_a_group_of_near_copies_that_differ_from_each_other(spark, monkeypatch, block):
    """Each copy is near its base and mostly not near the others; passages shared by many join nothing."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    texts = [edited(rng, base, 5) for _ in range(60)]
    texts.insert(33, " ".join(base))
    passage = " ".join(f"p{i}" for i in range(100))
    texts += [passage + " " + " ".join(f"q{j}_{i}" for i in range(60)) for j in range(80)]
    chain = [f"c{i}" for i in range(400)]
    for j in range(6):
        texts.append(" ".join(chain))
        chain = edited(rng, chain, 6).split()
    texts += ["tiny text", "tiny text", "tiny  text", "other tiny"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(df.collect())
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()}
    assert got == want


def test_probability_jaccard():
    """Registers agree with the probability of the probability Jaccard similarity, also of weighted shingles."""
    a = " ".join(f"w{i % 50} z{i}" for i in range(200))
    b = " ".join(f"w{i % 50} z{i}" for i in range(60, 260))
    words = Words(pa.array([a, b]))
    found, row, weight = minhash.weighted(*minhash.shingles(words, 1))
    won = minhash.sketch(found, row, weight, 2, 4096)
    x, y = ({int(e): w for e, w in zip(found[row == i], weight[row == i])} for i in (0, 1))
    both = set(x) & set(y)
    every = set(x) | set(y)
    jp = sum(1 / sum(max(x.get(z, 0) / x[e], y.get(z, 0) / y[e]) for z in every) for e in both)
    assert abs((won[0] == won[1]).mean() - jp) < 0.04


def test_minhash_odd(odd, docs):
    rows = minhash.near_duplicates(odd).collect()
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    assert len(rows) == odd.count() and sum(r.class_id is None for r in rows) == 2
    classes_ = {r.doc_id: r.class_id for r in rows}
    twins = [k for k, t in texts.items() if t == "same text here"]
    assert {classes_[k] for k in twins} == {min(twins)}
    assert all(classes_[k] == k for k, t in texts.items() if not (t or "").split())
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    links += [(5, 5), (None, 3), (7, None)]
    nodes = {x for a, b in links if a is not None and b is not None and a != b for x in (a, b)}
    want = classes(nodes, [(a, b) for a, b in links if a in nodes and b in nodes])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in want.items()}


def test_repeated_shingles_do_not_hide_a_pair(spark):
    """Equal shingle sets, one block of ten words two times against very many."""
    rows = []
    for k in range(12):
        words, block = [f"w{k}x{i}" for i in range(300)], [f"b{k}x{i}" for i in range(10)]
        rows += [(10 * k + n, " ".join(words + block * times)) for n, times in enumerate((2, 40, 100, 200))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.class_id == r.doc_id // 10 * 10 for r in found) and len(found) == len(rows)
