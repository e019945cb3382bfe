"""A corpus pipeline over ``documents``: each stage is a (spark, docs, sf_dir) function that returns a DataFrame.

All stages but the last return the columns of ``documents``; a stage works on what the one before it has kept.
``doc_id`` names a document: rows that repeat one are taken for the same document. A null text has no language and goes in
the first stage, as do texts without a letter. Every stage takes an empty table, and columns of any other name come along.
What a stage puts aside it deletes itself, but for the one table that its result reads.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from inplay.llm import language, lines, minhash, packing, queries, substrings
from inplay.llm.common import delete, kept_path, table, unused


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def _with_kept(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the text ``kept``. A text of which nothing is left goes, one that lost nothing stays as it was."""
    found = found.where((F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept")} | {c: F.col("carry").getField(c) for c in _others(docs)}
    columns["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return found.select(*(columns[c].alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is recognised."""
    name = unused(docs, "_language")
    return language.identified(docs, into=name).where(~F.col(name).getField("rejected")).select(*docs.columns)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that occurred before; documents that lose all lines go."""
    return _with_kept(docs, lines.deduplicate_lines(docs, carry=_others(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class; rows without an id stay.

    Of several rows under one id that with the least hash of its text stays, then of its other columns: the same one in every run.
    """
    kept, hashes = unused(docs, "_kept"), unused(docs, "_hashes")
    found = minhash.near_duplicates(docs)
    found = found.where(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias(kept)).distinct()
    rest = [F.col(c).cast("string") if c != "text" else F.col(c) for c in docs.columns]
    rows = docs.join(found, docs["doc_id"] == found[kept]).select(
        "doc_id", F.struct(*docs.columns).alias(kept), F.struct(F.xxhash64("text"), F.xxhash64("text", F.lit(1)), F.xxhash64(*rest)).alias(hashes))
    once = rows.groupBy("doc_id").agg(F.min_by(kept, hashes).alias(kept)).select(*(F.col(kept).getField(c).alias(c) for c in docs.columns))
    return docs.where("doc_id IS NULL").unionByName(once)


def remove_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of 35 words that occur anywhere else; documents of which nothing is left go."""
    return _with_kept(docs, substrings.remove_repeats(docs, 35, carry=_others(docs), as_it_was=True))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece with its sequence of at most 4096 tokens and its place there."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path(queries.TOKENIZER)))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", deduplicate_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", remove_substrings),
    ("best-fit packing", pack_sequences),
]

#: No SQL: the stages cannot be expressed there. tests/llm compare run() with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what every other stage returns is written to the shared folder and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = kept_path(spark, f"stage{k}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        # What the stage has read was written by this run for it alone.
        if before:
            delete(spark, before)
        before = path
