"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

A word's letters are a binary vector whose dimensions are the pairs of a letter and the how-manieth it is in the word.
One inserted, deleted or replaced letter changes at most two dimensions. The letters are dealt into ``PARTS`` parts; a
signature enumerates what the vector has in all parts but two, so words one edit apart agree in a signature at least.
One edit leaves the first or the second half of a word as it is; a key joins a signature with one such half, which
keeps the many words of the same letters apart. Words are joined on equal keys and verified by their edit distance in
the join itself, so that candidates are never written. Equal parts give equal keys: no near pair is missed, and what a
64-bit hash makes equal by chance is refused by the verification.

A key has few words, because they agree in half of their letters and half of their spelling; the join is a sort-merge
join, which spills and is split by Spark where a key is hot. Near words of a word are bounded by the alphabet.

Defined cases: a null or empty text has no words, a null id counts as the empty text. Long texts are taken whole; a
run of any length is one word. Repeated rows count again. Ties of a form go to the word that is smaller in code-point
order. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from inplay.llm.common import mix, scratch, slices, sql_crc32, stored

#: Parts the letters are dealt into; a signature leaves out two of them.
PARTS = 4
#: Distinct words that a task counts before it hands them on.
_COUNTED = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_counts(docs: DataFrame, least_chars: int = 7, least_count: int = 2, typos: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of A-Z, a-z and U+00C0 to U+00FF that occur often enough; only A-Z become small.

    With ``typos``, a word loses a letter in those documents where this number divides the CRC-32 of ``<id>:<word>``:
    the one at this CRC modulo the word's length. Lengths are those afterwards.
    """
    letters = re.compile("[a-zÀ-ÿ]{%d,}" % least_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for id_, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if not text:
                        continue
                    # Of bytes, lower() changes A-Z alone.
                    words = letters.findall(text.encode().lower().decode())
                    if typos:
                        begin = zlib.crc32(f"{id_ or ''}:".encode())
                        own = Counter(words)
                        for word in list(own):
                            crc = zlib.crc32(word.encode(), begin)
                            if crc % typos == 0:
                                n, at = own.pop(word), crc % len(word)
                                if len(word) > least_chars:
                                    total[word[:at] + word[at + 1:]] += n
                        total.update(own)
                    else:
                        total.update(words)
                    if len(total) > _COUNTED:
                        yield counted(total)
                        total = Counter()
        yield counted(total)

    def counted(total: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def dealt_letters(words: DataFrame) -> dict[int, int]:
    """Code point to part: letters in the order of how often they occur in ``words``, dealt to and fro. An alphabet is small."""
    rows = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()
    order = sorted((-r["count"], ord(r["letter"])) for r in rows if r["letter"])
    there_and_back = [*range(PARTS), *reversed(range(PARTS))]
    return {code: there_and_back[k % len(there_and_back)] for k, (_, code) in enumerate(order)}


def with_keys(words: DataFrame, part_of: dict[int, int]) -> DataFrame:
    """``words`` (word, n) with ``key``: a row for each signature and each half that one edit can leave as it is."""
    # Any code point may come in words that another caller counted; those without a part share the first.
    largest = max(part_of, default=0)
    part = np.zeros(largest + 2, np.uint8)
    for code, p in part_of.items():
        part[code] = p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "word", 1 << 20):
                keys = word_keys(some.column(0).to_pylist(), part)
                at = np.repeat(np.arange(some.num_rows), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), some.column(0).take(pa.array(at)), some.column(1).take(pa.array(at))], ["key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long")


def word_keys(words: list[str], part: np.ndarray) -> np.ndarray:
    """The keys of each word, one row a word."""
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.array([len(w) for w in words])
    first = np.cumsum(size) - size
    own = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(code)) - first[own]
    # What a vector has in a part: the sum of its letters' hashes, which is the same in any order.
    sums = np.zeros((PARTS, len(words)), np.uint64)
    letter = mix((code.astype(np.uint64) + np.uint64(1)) * _ODD)
    for p in range(PARTS):
        sums[p] = np.add.reduceat(np.where(part[np.minimum(code, len(part) - 1)] == p, letter, np.uint64(0)), first)
    ahead = mix(letter ^ mix(place.astype(np.uint64) + np.uint64(7)))
    behind = mix(letter ^ mix((size[own] - place).astype(np.uint64) + np.uint64(1 << 32)))
    half = size // 2
    # The halves of the word, and those of a word that is one letter shorter: three distinct ones for any length.
    spelled = [(ahead, place < half[own]),
               (behind, place >= half[own]),
               (np.where(size[own] % 2 == 0, ahead, behind), np.where(size[own] % 2 == 0, place < half[own] - 1, place > half[own]))]
    halves = [np.add.reduceat(np.where(there, hashed, np.uint64(0)), first) for hashed, there in spelled]
    signatures = []
    for number, kept in enumerate(combinations(range(PARTS), PARTS - 2)):
        value = np.full(len(words), np.uint64(number + 1))
        for p in kept:
            value = mix(value * _ODD + sums[p])
        signatures.append(value)
    return np.stack([mix(s ^ mix(h)) for s in signatures for h in halves], axis=1)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two of ``words`` (word, n) that are one edit apart, in both directions, once."""
    keyed = with_keys(words, dealt_letters(words))
    a, b = keyed.alias("a"), keyed.alias("b")
    met = a.join(b.hint("merge"), (F.col("a.key") == F.col("b.key")) & (F.col("a.word") < F.col("b.word"))
                 & (F.abs(F.char_length("a.word") - F.char_length("b.word")) <= 1) & (F.levenshtein("a.word", "b.word", 1) == 1))
    both = F.explode(F.array(*(F.struct(F.col(f"{x}.word").alias("word"), F.col(f"{x}.n").alias("n"), F.col(f"{y}.word").alias("near"), F.col(f"{y}.n").alias("near_n"))
                               for x, y in ("ab", "ba"))))
    # Dealt by word once: what follows needs no other exchange.
    return met.select(both.alias("p")).select("p.*").repartition("word").distinct()


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n).

    ``form`` is the near word of the largest n if that is ``ratio`` times the word's own n, ``root`` the last of the
    forms that follow one from another.
    """
    with scratch(words.sparkSession):
        return stored(_variants(stored(words, "words"), ratio), "variants", keep=True)


def _variants(words: DataFrame, ratio: int) -> DataFrame:
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near"))).alias("best"))
    found = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *(F.when(F.col("best.near_n") >= ratio * F.col("n"), F.col(f"best.{c}")).alias(name) for c, name in (("near", "form"), ("near_n", "form_n")))), "forms")
    roots = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # Each form has ratio times the n of the word before, which bounds how many follow; each round doubles the steps taken.
    most, steps = found.agg(F.max("n")).first()[0] or 1, 1
    while ratio > 1 and ratio ** steps < most:
        steps += 1
    for _ in range(ceil(log2(steps)) if steps > 1 else 0):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle() -> str:
    """SQL for the variants of the words of ``documents``: near words by the text that is left without one letter."""
    crc = sql_crc32("list_transform(range(1, strlen(x), 2), lambda i: CAST(16 * (strpos('0123456789ABCDEF', x[i]) - 1) + strpos('0123456789ABCDEF', x[i + 1]) - 1 AS BIGINT))")
    return f"""
    WITH RECURSIVE occurrences AS (SELECT doc_id, w, count(*) AS n FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{7,}}')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents) GROUP BY ALL),
    digits AS (SELECT *, hex(encode(doc_id || ':' || w)) AS x FROM occurrences),
    coded AS (SELECT w, n, {crc} AS h FROM digits),
    words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM coded) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    gaps AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS short FROM words, unnest(range(1, length(word) + 1)) t(i)),
    pairs AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.short = b.short AND a.word <> b.word
      UNION SELECT g.word, g.n, s.word, s.n FROM gaps g JOIN words s ON g.short = s.word
      UNION SELECT s.word, s.n, g.word, g.n FROM gaps g JOIN words s ON g.short = s.word),
    best AS (SELECT word, count(*) AS n_near, arg_min({{'near': near, 'near_n': near_n}}, {{'a': -near_n, 'b': encode(near)}}) AS b FROM pairs GROUP BY word),
    forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n FROM words w LEFT JOIN best USING (word)),
    roots AS (SELECT word, word AS root, 0 AS steps FROM forms UNION ALL SELECT r.word, f.form, steps + 1 FROM roots r JOIN forms f ON f.word = r.root WHERE f.form IS NOT NULL)
    SELECT word, form, (SELECT arg_max(root, steps) FROM roots r WHERE r.word = f.word) AS root, n, n_near, form_n FROM forms f"""
