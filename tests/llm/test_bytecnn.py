import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from inplay.llm import bytecnn, queries


def plain_score(net, text):
    """The network's probability from its definition, position by position."""
    data = list(text) or []
    tail = data + [256] * (bytecnn.BLOCK + bytecnn.WIDTH)
    n = max(1, len(data))
    z = np.array([net.bias + sum(net.vectors[tail[p + k]] @ net.filters[k] for k in range(bytecnn.WIDTH)) for p in range(n)])
    z = np.maximum(z, 0)
    blocks = -(-n // bytecnn.BLOCK)
    pooled = np.array([z[c * bytecnn.BLOCK:(c + 2) * bytecnn.BLOCK].max(0) for c in range(max(1, blocks - 1))])
    inner = np.maximum(pooled @ net.hidden + net.hidden_bias, 0)
    both = np.concatenate([inner.max(0), inner.mean(0)])
    return 1 / (1 + np.exp(-(both @ net.last + net.last_bias[0])))


def test_scores_equal_plain_version():
    net = bytecnn.Network.random(3)
    net.bias += 0.1
    rng = random.Random(1)
    texts = ["", "a", "abc", "é" * 64, "x" * 128, "y" * 129, None, "", "".join(chr(rng.randrange(32, 400)) for _ in range(5000))]
    texts += ["".join(rng.choice("ab c\n") for _ in range(n)) for n in (127, 128, 255, 256, 257, 1000)]
    got = bytecnn.scores(net, net.pair_tables(), pa.array(texts))
    assert got == pytest.approx([plain_score(net, (t or "").encode()) for t in texts], abs=1e-5)
    # Slices and offsets do not matter.
    assert bytecnn.scores(net, net.pair_tables(), pa.array(texts).slice(3, 9)) == pytest.approx(got[3:12], abs=1e-6)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(5)
    net = bytecnn.Network(*(p.astype(np.float64) for p in bytecnn.Network.random(2).parameters()))
    net.bias += 0.2
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (0, 3, 200, 500)]
    labels, weights = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 0.5])
    x = [bytecnn._chunks(t) for t in texts]
    first = np.cumsum([0, *map(len, x)])[:-1]

    def loss():
        p = np.array([plain_score(net, t) for t in texts])
        return -(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / weights.sum()

    for p, g in zip(net.parameters(), bytecnn._gradients(net, np.concatenate(x), first, labels, weights)):
        # The largest entries are those that the texts touch.
        for at in np.argsort(-np.abs(g).ravel())[:3]:
            at = np.unravel_index(at, p.shape)
            old = p[at]
            p[at] = old + 1e-4
            up = loss()
            p[at] = old - 1e-4
            down = loss()
            p[at] = old
            assert g[at] == pytest.approx((up - down) / 2e-4, rel=0.05, abs=1e-5)


def corpus(rng, n):
    """Prose of many words against one word over and over, signs, and capitals."""
    out = []
    for i in range(n):
        words = ["".join(rng.choice("aeiorstn") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
        kind = i % 6
        text = {0: " ".join([words[0]] * 60), 1: " ".join(w + "%%%" for w in words), 2: " ".join(words).upper() + "!!"}.get(kind, " ".join(words))
        out.append((i, text, int(kind > 2)))
    return out


def test_held_out_accuracy(spark):
    rows = corpus(random.Random(8), 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    got = bytecnn.judged(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got) and len(got) == 900
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == rows[r.doc_id][2] for r in held) >= 0.97 * len(held)
    # What the held-out rows are labelled does not matter.
    other = labels.selectExpr("doc_id", "IF(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, 1 - quality, quality) AS quality")
    assert [r.score for r in bytecnn.judged(docs, other).orderBy("doc_id").collect()] == pytest.approx([r.score for r in sorted(got)], abs=1e-6)


def test_op11(spark, sf, docs):
    got = queries.op11_byte_cnn(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out is not None for r in rows)


def test_classifier_odd(spark, odd):
    some = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (4, 1), (None, 1), (6, None)], "doc_id long, quality int")
    for labels in (some, some.limit(0), some.where("quality = 1")):
        got = bytecnn.judged(odd, labels).collect()
        assert len(got) == odd.count() and all(r.held_out is not None and 0 <= r.score <= 1 for r in got)
    assert {r.score for r in bytecnn.judged(odd, some.limit(0)).collect()} == {0.5}
    assert bytecnn.judged(odd.limit(0), some).count() == 0
