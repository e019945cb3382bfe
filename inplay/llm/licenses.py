"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Texts and templates are folded (small letters, punctuation as spaces) and cut into word shingles. Windows of ``WINDOW``
words begin at every ``STRIDE``-th word of a text and at every word of a template. A window's MinHash values are its
bands of one row each: windows that share a part s of their shingles share a band with a probability of 1 - (1 - s) ** bands.
A template as short as one shingle is a quarter of the shingles of any window that holds it whole, and a stride of at
most WINDOW - WIDTH + 1 words leaves one that does: 0.9999 for 32 bands. Longer templates have windows that agree wholly with the text's.
A retrieved template matches if the text has at least ``threshold`` of its shingles.

Only texts with a key word are windowed. This loses nothing: so many shingles of each template hold a key word that
``threshold`` of them cannot do without, which is checked for the templates given.

Defined cases: a null text matches nothing, nor does one with fewer words than a shingle. Rows that repeat an id match
each. An empty table gives an empty result; templates shorter than a shingle are refused.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WIDTH, WINDOW, STRIDE, BANDS = 5, 8, 2, 32
_FROM = "\t\n\x0b\x0c\r.,;:!?()[]{}<>\"'`*_/\\|#~=&%$@^"
#: A shingle counts as telling if one of its words begins with one of these.
KEY_WORDS = ["licen", "copyright", "permission", "redistribut", "warrant", "spdx", "binary", "mozilla"]

# Statements of well-known licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def folded(text: Column) -> Column:
    """Words in small letters without punctuation, one space between them."""
    return F.filter(F.split(F.translate(F.lower(text), _FROM, " " * len(_FROM)), " +"), lambda w: w != "")


def _words(text: str) -> list[str]:
    return text.lower().translate(str.maketrans(_FROM, " " * len(_FROM))).split()


def key_words_suffice(templates: dict[str, str], threshold: float) -> None:
    """Refuse templates that a text could match without any key word."""
    for name, text in templates.items():
        words = _words(text)
        rows = {" ".join(words[i:i + WIDTH]) for i in range(len(words) - WIDTH + 1)}
        if not rows:
            raise ValueError(f"template {name} has fewer than {WIDTH} words")
        telling = sum(bool(re.search("|".join(rf"(^| ){k}" for k in KEY_WORDS), r)) for r in rows)
        if len(rows) - telling >= threshold * len(rows):
            raise ValueError(f"template {name} can be matched without a key word")


def shingles(words: Column) -> Column:
    """Distinct or not, the hashed runs of ``WIDTH`` words."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - WIDTH + 1), lambda i: F.xxhash64(F.array_join(F.slice(words, i, WIDTH), " ")))


def bands(hashed: Column, begins: Column) -> Column:
    """The distinct bands of the windows that begin at these shingles (from 1)."""
    def of_window(i: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.xxhash64(b, F.array_min(
            F.transform(F.slice(hashed, i, WINDOW - WIDTH + 1), lambda x: F.xxhash64(x, b)))))

    return F.array_distinct(F.flatten(F.transform(begins, of_window)))


def _hashed(rows: DataFrame) -> DataFrame:
    """Rows whose ``words`` make a shingle, with ``hashed``."""
    return rows.where(F.size("words") >= WIDTH).withColumn("hashed", shingles(F.col("words")))


def _begins(stride: int) -> Column:
    # The last window ends with the text; a text shorter than a window is one.
    last = F.greatest(F.size("hashed") - (WINDOW - WIDTH), F.lit(1))
    return F.array_union(F.sequence(F.lit(1), last, F.lit(stride)), F.array(last))


def template_rows(spark: SparkSession, templates: dict[str, str], threshold: float) -> DataFrame:
    """(license, own, bands): each template's distinct shingles and bands. As many rows as templates are given."""
    key_words_suffice(templates, threshold)
    rows = spark.createDataFrame(sorted(templates.items()), "license string, template string")
    rows = _hashed(rows.select("license", folded(F.col("template")).alias("words")))
    return rows.select("license", F.array_distinct("hashed").alias("own"), bands(F.col("hashed"), _begins(1)).alias("bands"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, license, containment): each template of which a text has at least ``threshold`` of the shingles."""
    found = template_rows(docs.sparkSession, templates or TEMPLATES, threshold)
    low = F.lower(F.col(text_col))
    telling = low.contains(KEY_WORDS[0])
    for word in KEY_WORDS[1:]:
        telling = telling | low.contains(word)
    rows = _hashed(docs.where(telling).select(F.col(id_col).alias("id"), folded(F.col(text_col)).alias("words")))
    rows = rows.select(F.struct("id", F.monotonically_increasing_id().alias("row")).alias("id"), "hashed", bands(F.col("hashed"), _begins(STRIDE)).alias("bands"))
    # Templates are given as an argument, so their side is as small as that.
    met = rows.join(F.broadcast(found.withColumnRenamed("bands", "theirs")), F.arrays_overlap("bands", "theirs"))
    share = F.size(F.array_intersect("own", "hashed")) / F.size("own")
    return met.select(F.col("id.id").alias(id_col), "license", share.alias("containment")).where(F.col("containment") >= threshold)


def oracle(threshold: float = 0.8) -> str:
    """Exact containment of every template in every text, for another engine."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    chars = " || ".join(f"chr({ord(c)})" for c in _FROM)
    words = f"list_filter(string_split(translate(lower({{}}), {chars}, '{' ' * len(_FROM)}'), ' '), lambda w: w <> '')"
    runs = f"list_transform(range(1, len(words) - {WIDTH - 2}), lambda i: array_to_string(words[i:i + {WIDTH - 1}], ' '))"
    values = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in sorted(TEMPLATES.items()))
    return f"""
WITH t AS (SELECT license, {words.format('template')} AS words FROM (VALUES {values}) v(license, template)),
own AS (SELECT license, list_distinct({runs}) AS own FROM t),
d AS (SELECT doc_id, {words.format('text')} AS words FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, {runs} AS hashed FROM d WHERE len(words) >= {WIDTH})
SELECT doc_id, license, len(list_intersect(own, hashed)) / len(own) AS containment FROM s, own
WHERE len(list_intersect(own, hashed)) >= {threshold} * len(own)"""
