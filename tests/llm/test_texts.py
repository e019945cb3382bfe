"""Substring removal and language identification against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

from inplay.llm import language, queries, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def removed(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_op3(spark, sf, docs):
    source = docs.collect()
    expected = {r.doc_id: x for r, x in zip(source, removed([r.text for r in source], 35))}
    rows = queries.op3_substring_dedup(spark, sf).collect()
    assert len(rows) == len(source)
    for r in rows:
        n, gone, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
    assert any(r.n_removed for r in rows)


def test_substrings_odd(odd):
    source = odd.collect()
    for window in (3, 35):
        rows = substrings.remove_repeats(odd, window).collect()
        assert sorted((r.n_words, r.n_removed, r.kept) for r in rows) == sorted(removed([r.text for r in source], window))
        for r in rows:
            assert sum(s.end - s.begin for s in r.removed) == r.n_removed
            assert all(a.end < b.begin for a, b in zip(r.removed, r.removed[1:]))
    assert substrings.remove_repeats(odd.limit(0)).count() == 0


def test_substrings_between_chunks(spark, monkeypatch):
    """Many small chunks and cut buckets give what one chunk gives."""
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 200)
    monkeypatch.setattr(substrings, "BUCKET_HASHES", 2)
    texts = [" ".join(f"w{(i * j) % 11}" for j in range(5 + i % 40)) for i in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(df, 6).collect()}
    assert [rows[i] for i in range(150)] == removed(texts, 6)


def test_op10(spark, sf, docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = queries.op10_language(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(held) >= 0.97 * len(held)
    assert not any(r.rejected for r in rows if r.held_out and len(str(lang[r.doc_id])) == 0)


def test_labels_and_held_out_rows_teach_nothing_they_should_not(spark, docs):
    """A text's own label, and labels of held-out rows, change no prediction."""
    changed = docs.withColumn("lang", __import__("pyspark.sql.functions", fromlist=["expr"]).expr(
        "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 'zz' ELSE lang END"))
    a, b = (sorted((r.doc_id, r._language.lang) for r in language.identified(d).select("doc_id", "_language").collect()) for d in (docs, changed))
    assert a == b


def test_language_odd(odd, docs, spark):
    model = language.fit(docs)
    rows = odd.withColumn("found", language.identify(odd, model)).collect()
    for r in rows:
        if r.text is None or not re.search(r"[^\W\d_]", r.text):
            assert (r.found.lang, r.found.score, r.found.rejected) == ("und", 0.0, True)
        else:
            assert r.found.lang in model.langs
    empty = language.fit(docs.limit(0))
    assert {r.found.lang for r in odd.withColumn("found", language.identify(odd, empty)).collect()} == {"und"}
    assert odd.limit(0).withColumn("found", language.identify(odd, model)).count() == 0
