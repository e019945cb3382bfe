"""Language identification by the nearest of several centroids per language.

A text's vector holds the counts of its hashed byte 2- and 3-grams, damped, weighted by inverse document frequency
and normalised. The vectors of labelled texts are clustered per language (spherical k-means); a text gets the
language of the centroid with the highest cosine, and is rejected if that cosine is under the language's bound.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected. Rows with a null label
teach nothing. Equal cosines go to the language that sorts first. Without any labelled row every text is ``und``.
Repeated rows are predicted each; an empty table gives an empty result; long texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from inplay.llm.common import slices, text_bytes

UNKNOWN = "und"
#: Hashed n-grams in a vector.
DIMENSIONS = 4096
#: Texts in one numpy step at most; bounds memory.
_ROWS = 1024
_LETTER = regex.compile(r"\p{L}")
# ASCII capitals count as small letters, all other ASCII than letters as a space.
_FOLD = np.array([i if i >= 128 else ord(chr(i).lower()) if chr(i).isalpha() else 32 for i in range(256)], np.uint32)
_ASCII_LETTER = np.array([i < 128 and chr(i).isalpha() for i in range(256)])


def gram_counts(column: pa.Array) -> np.ndarray:
    """Rows of n-gram counts, one for each text."""
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    out = np.zeros(rows * DIMENSIONS, np.int64)
    b = _FOLD[data]
    owner = np.repeat(np.arange(rows) * DIMENSIONS, np.diff(offsets))
    for n in (2, 3):
        if len(b) >= n:
            gram = np.uint32(n) << np.uint32(24)
            for k in range(n):
                gram = gram + (b[k:len(b) - n + 1 + k] << np.uint32(8 * k))
            at = (gram * np.uint32(2654435761)) >> np.uint32(20)
            inside = owner[:len(gram)] == owner[n - 1:]
            out += np.bincount((at + owner[:len(gram)])[inside], minlength=len(out))
    return out.reshape(rows, DIMENSIONS)


@dataclass(frozen=True)
class Centroids:
    """What was learnt: gram weights, centroids (rows) with their languages, and each language's least cosine."""

    idf: np.ndarray
    rows: np.ndarray
    langs: list[str]
    least: dict[str, float]

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts.astype(np.float32)) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most ``k`` unit centroids of unit rows: seeds far from each other, then spherical k-means."""
    centre = x.mean(0, keepdims=True)
    near = (x @ centre.T)[:, 0]
    seeds = [int(near.argmax())]
    best = x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(best.argmin()))
        best = np.maximum(best, x @ x[seeds[-1]])
    c = x[seeds]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == i].mean(0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = 4000,
        per_language: int = 4, slack: float = 0.5) -> Centroids:
    """Learn from about ``fit_rows`` labelled rows, the same number of each language, drawn by a hash of the id.

    ``slack``: a text is rejected under this part of the least cosine but one in a thousand that the language's own
    sample has.
    """
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    count = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}
    if not count:
        return Centroids(np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), [], {})
    cells = 1 << 30
    share = F.create_map(*(F.lit(v) for k, n in sorted(count.items()) for v in (k, min(cells, -(-fit_rows * cells // (len(count) * n))))))
    drawn = known.where(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(cells)) < share[F.col(lang_col)])

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for a in range(0, part.num_rows, _ROWS):
                    own = part.slice(a, _ROWS)
                    grams = np.minimum(gram_counts(own.column(1)), 65535).astype(np.uint16)
                    yield pa.RecordBatch.from_arrays([own.column(0), pa.array([g.tobytes() for g in grams], pa.binary())], ["lang", "grams"])

    rows = drawn.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sample = rows.mapInArrow(count_grams, "lang string, grams binary").toArrow()
    lang = np.array(sample["lang"].to_pylist(), object)
    counts = np.frombuffer(b"".join(sample["grams"].to_pylist()), np.uint16).reshape(-1, DIMENSIONS)
    seen = (counts > 0).sum(0)
    model = Centroids((np.log((1 + len(counts)) / (1 + seen)) + 1).astype(np.float32), np.zeros((0, DIMENSIONS)), [], {})
    x = model.vectors(counts)
    # The sample arrives in no fixed order; the sums must not depend on it.
    order = np.lexsort(x[:, :64].T)
    x, lang = x[order], lang[order]
    centroids, names, least = [], [], {}
    for name in sorted(set(lang)):
        own = x[lang == name]
        found = clusters(own, per_language)
        centroids.append(found)
        names += [name] * len(found)
        least[name] = float(slack * np.quantile((own @ found.T).max(1), 0.001))
    return Centroids(model.idf, np.concatenate(centroids).astype(np.float32), names, least)


def identify(docs: DataFrame, model: Centroids, text_col: str = "text") -> Column:
    """A column of structs (lang, score, rejected) for the texts of ``docs``; use it with ``withColumn``."""

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def run(column: pa.Array) -> pa.Array:
        lang, score, rejected = [], [], []
        for part in slices(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
            for a in range(0, part.num_rows, _ROWS):
                own = part.column(0).slice(a, _ROWS)
                lettered = has_letter(own)
                if len(model.rows):
                    cosine = model.vectors(gram_counts(own)) @ model.rows.T
                    best = cosine.argmax(1)
                    value = np.clip(cosine[np.arange(len(best)), best].astype(float), 0.0, 1.0)
                for i, ok in enumerate(lettered):
                    name = model.langs[best[i]] if ok and len(model.rows) else UNKNOWN
                    lang.append(name)
                    score.append(float(value[i]) if name != UNKNOWN or ok and len(model.rows) else 0.0)
                    rejected.append(not ok or not len(model.rows) or score[-1] < model.least[name])
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["lang", "score", "rejected"])

    return run(F.col(text_col))


def has_letter(column: pa.Array) -> list[bool]:
    """Whether each text has a letter; a null text has none."""
    data, offsets = text_bytes(column)
    before = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    found = (before[offsets[1:]] > before[offsets[:-1]]).tolist()
    return [ok or bool(offsets[i + 1] > offsets[i] and _LETTER.search(column[i].as_py())) for i, ok in enumerate(found)]


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether the row belongs to the fold that nothing is learnt from; a row without an id does."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", into: str = "_language") -> DataFrame:
    """``docs`` with the struct ``into``, learnt from the rows that are not held out."""
    model = fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    return docs.withColumn(into, identify(docs, model, text_col))
