import hashlib

import numpy as np
import pyarrow as pa

from inplay.llm import fingerprints, queries


def brute(rows):
    """(id, n_chars, edited sha256, edited, next text) by descending id; ties by nothing, so ids must differ."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        size = len(t) // 3
        edited = t[:len(t) - size] + after[:size]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), t, edited, after)
    return out


def digest(text):
    """A text's digest, from its definition."""
    b = text.encode()
    counts = [0] * 256
    for x, y, z in zip(b, b[1:], b[2:]):
        counts[((x | y << 8 | z << 16) * 2654435761 & 0xFFFFFFFF) >> 24] += 1
    s = sorted(counts)
    codes = [sum(c > q for q in (s[64], s[128], s[192])) for c in counts]
    packed = [codes[i] << 6 | codes[i + 1] << 4 | codes[i + 2] << 2 | codes[i + 3] for i in range(0, 256, 4)]
    return bytes([min(255, int(np.log1p(len(b)) / np.log(1.1)))] + packed).hex()


def check(got, rows):
    want = brute(rows)
    assert sorted(r[0] for r in got) == sorted(want)
    for r in got:
        n, sha, text, edited, after = want[r[0]]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, sha, digest(text), digest(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_next == 1 or digest(after) != r.fingerprint


def test_op2(spark, sf, docs):
    rows = queries.op2_fingerprints(spark, sf).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert np.mean([r.near_edited for r in rows]) > np.mean([r.near_next for r in rows]) + 0.1


def test_small_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    rows = [(i * i * (-1) ** i, None if i == 5 else f"text {i} " * (i % 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(fingerprints.edited_by_next(df).collect(), rows)


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")
    check(fingerprints.edited_by_next(df).collect(), [(4, "abcdef")])
    assert fingerprints.edited_by_next(df.limit(0)).count() == 0


def test_fingerprints_odd(odd):
    rows = fingerprints.edited_by_next(odd).collect()
    assert len(rows) == odd.count()
    known = [r for r in rows if r.doc_id is not None]
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert all(r.fingerprint == digest(texts[r.doc_id] or "") for r in known)


def test_likeness_is_bounded():
    d = fingerprints.digests(pa.array(["", "abc" * 500, "".join(map(chr, range(32, 2000))), "abc" * 500]))
    x, y = np.repeat(d, 4, 0), np.tile(d, (4, 1))
    like = fingerprints.likeness(x, y)
    assert ((0 <= like) & (like <= 1)).all() and like[7] == 1 and like[1] < 1
