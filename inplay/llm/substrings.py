"""Removal of token windows that occur more than once in a corpus.

Words are runs of anything but ASCII white space. Every run of ``window`` words of a text has a Rabin-Karp hash. A
window is repeated if its hash begins anywhere else too, in the same text included; overlapping and adjacent repeated
windows merge into maximal intervals, whose words are removed.

Texts are dealt by a hash into chunks. A chunk sends each of its hashes once to the bucket that the hash belongs to; a
bucket counts in how many chunks it occurs and sends one bit for each back. So a passage in a third of all texts
costs a bucket one entry for each chunk, and chunks and buckets are of bounded size whatever the texts are.

Defined cases: a null text has no words, and so has an empty one. Repeated rows repeat each other's windows. Texts
shorter than the window keep all words. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from inplay.llm.common import Words, carried

#: Bytes of text in a chunk, and hashes in a bucket, on average. They bound a task's memory.
CHUNK_BYTES = 8 << 20
BUCKET_HASHES = 2 << 20
#: Buckets by the first byte of a hash; the others are sent. Each is cut further where it is too large.
_FIRST = 256


def chunk_windows(texts: pa.ChunkedArray, width: int) -> tuple[list[Words], list[np.ndarray], np.ndarray, np.ndarray]:
    """Words of each array, hashes of their windows with where they begin, the distinct hashes (sorted), and which occur twice here."""
    words = [Words(part) for part in texts.chunks]
    found = [w.windows(w.hashes(), width) for w in words]
    hashes = np.sort(np.concatenate([h for h, _ in found])) if found else np.zeros(0, np.uint64)
    first = np.concatenate([[True], hashes[1:] != hashes[:-1]])[:len(hashes)]
    distinct = hashes[first]
    twice = np.diff(np.concatenate([np.flatnonzero(first), [len(hashes)]])) > 1
    return words, found, distinct, twice


def bounds(distinct: np.ndarray, parts: int) -> np.ndarray:
    """Where each of the ``parts`` equal ranges of hashes begins in the sorted hashes, and the end."""
    step = (1 << 64) // parts
    edges = np.array([i * step for i in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(distinct, edges), [len(distinct)]])


def intervals(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text",
                   carry: Sequence[str] = (), as_it_was: bool = False) -> DataFrame:
    """(id, n_words, n_removed, removed, kept): ``removed`` are intervals of word positions [begin, end), ``kept`` is the
    text of all other words joined by one space, or if ``as_it_was`` the text itself where no word is removed. One row for
    each row of ``docs``. The columns ``carry`` come along as they are, in a struct of this name.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    chunks = max(8, -(-size // CHUNK_BYTES))
    # A word and its space take two bytes at least; six are usual.
    parts = _FIRST * max(1, -(-size // (6 * BUCKET_HASHES * _FIRST)))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *([F.struct(*carry).alias("carry")] if carry else []))
    dealt = source.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int"))
    step = (1 << 64) // parts

    def send(key: tuple, rows: pa.Table) -> pa.Table:
        _, _, distinct, _ = chunk_windows(rows["text"], window)
        at = bounds(distinct, parts)
        # Within a bucket the hash's offset from the bucket's begin is under 2 ** 56, so seven bytes hold it.
        low = distinct - np.repeat(np.arange(parts, dtype=np.uint64) * np.uint64(step), np.diff(at))
        raw = np.ascontiguousarray(low).view(np.uint8).reshape(-1, 8)[:, :7].tobytes()
        full = np.flatnonzero(np.diff(at)).tolist()
        return pa.table({"bucket": pa.array(full, pa.int32()), "chunk": pa.array([key[0].as_py()] * len(full), pa.int32()),
                         "hashes": pa.array([raw[7 * at[i]:7 * at[i + 1]] for i in full], pa.binary())})

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        sent = rows["hashes"].to_pylist()
        raw = np.zeros((sum(map(len, sent)) // 7, 8), np.uint8)
        raw[:, :7] = np.frombuffer(b"".join(sent), np.uint8).reshape(-1, 7)
        h = raw.view(np.uint64)[:, 0]
        order = np.argsort(h, kind="stable")
        s = h[order]
        same = np.concatenate([[False], s[1:] == s[:-1], [False]])
        shared = np.empty(len(h), bool)
        shared[order] = same[:-1] | same[1:]
        ends = np.cumsum([len(x) // 7 for x in sent]).tolist()
        bits = [np.packbits(shared[a:b]).tobytes() for a, b in zip([0, *ends], ends)]
        return pa.table({"chunk": rows["chunk"], "bucket": pa.array([key[0].as_py()] * len(sent), pa.int32()), "bits": pa.array(bits, pa.binary())})

    def remove(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        words, found, distinct, repeated = chunk_windows(rows["text"], window)
        repeated = repeated.copy()
        at = bounds(distinct, parts)
        for i, bits in zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist()):
            own = slice(at[i], at[i + 1])
            repeated[own] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=own.stop - own.start).astype(bool)
        total, lost, spans, kept = [], [], [], []
        for w, (hashes, begin) in zip(words, found):
            change = np.zeros(len(w.starts) + 1, np.int64)
            hit = begin[repeated[np.searchsorted(distinct, hashes)]] if len(hashes) else begin
            np.add.at(change, hit, 1)
            np.add.at(change, hit + window, -1)
            covered = np.cumsum(change[:-1]) > 0
            data, starts, ends = w.data.tobytes(), w.starts.tolist(), w.ends.tolist()
            for a, b in zip(w.first.tolist(), w.first[1:].tolist()):
                gone = covered[a:b]
                left = (np.flatnonzero(~gone) + a).tolist() if gone.any() else range(a, b)
                total.append(b - a)
                lost.append(int(gone.sum()))
                spans.append([{"begin": int(x), "end": int(y)} for x, y in zip(*intervals(gone))] if lost[-1] else [])
                kept.append(b" ".join([data[starts[i]:ends[i]] for i in left]))
        if as_it_was:
            kept = [(t if t is None else t.encode()) if not n else k for t, n, k in zip(rows["text"].to_pylist(), lost, kept)]
        return pa.table({
            "id": rows["id"], "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(lost, pa.int64()),
            "removed": pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()), **({"carry": rows["carry"]} if carry else {})})

    answers = (dealt.groupBy("chunk").applyInArrow(send, "bucket int, chunk int, hashes binary")
               .groupBy("bucket").applyInArrow(count, "chunk int, bucket int, bits binary"))
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("removed", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.StringType()), *carried(docs, carry)])
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(remove, schema).withColumnRenamed("id", id_col)


def oracle() -> str:
    """SQL for the digests of ``documents`` without repeated windows of 35 words: windows as texts, counted."""
    return r"""
    WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
    windows AS (SELECT r, i, array_to_string(words[i:i + 34], ' ') AS w FROM rows, unnest(range(1, len(words) - 33)) t(i)),
    hits AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY w) AS n FROM windows) WHERE n > 1),
    gone AS (SELECT DISTINCT r, j FROM hits, unnest(range(i, i + 35)) t(j)),
    places AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS j FROM rows),
    kept AS (SELECT p.r, count(g.j) AS n_removed, string_agg(word, ' ' ORDER BY p.j) FILTER (WHERE g.j IS NULL) AS kept FROM places p LEFT JOIN gone g ON g.r = p.r AND g.j = p.j GROUP BY p.r)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM rows LEFT JOIN kept USING (r)"""
