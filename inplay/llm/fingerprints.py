"""Quartile bucket digests: hashed byte triplets counted in buckets, the buckets' quartiles and the length encoded.

A digest is hexadecimal: two digits of length (its logarithm), then two bits for each bucket, which say in which quarter
of the text's bucket counts it lies. Two digests differ by a bounded score: how far apart their buckets' quarters are,
a quarter against its opposite counting double, and how far apart the lengths are.

Defined cases: a null text is the empty text. Equal texts have equal digests. Rows without an id come last in descending
order; rows that repeat an id come one after another by a hash of their text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F, types as T

from inplay.llm.common import slices, text_bytes

BUCKETS = 256
_LENGTHS = 255
#: What a difference of 0 to 3 quarters counts, and what one step of length does, up to a most.
_APART = np.array([0, 1, 2, 6], np.int64)
_LENGTH_STEP, _LENGTH_MOST = 4, 64
#: Rows in a range of ids, on average, and ranges at most; a range is streamed, not held.
RANGE_ROWS, MOST_RANGES = 1024, 4096


def digests(column: pa.Array) -> np.ndarray:
    """One row of bytes for each text: the length's code, and ``BUCKETS`` / 4 bytes of quartile codes."""
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    b = data.astype(np.uint32)
    counts = np.zeros(rows * BUCKETS, np.int64)
    if len(b) >= 3:
        bucket = ((b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)) >> np.uint32(24)
        owner = np.repeat(np.arange(rows) * BUCKETS, np.diff(offsets))
        inside = owner[:-2] == owner[2:]
        counts += np.bincount((bucket + owner[:-2])[inside], minlength=len(counts))
    counts = counts.reshape(rows, BUCKETS)
    quartile = np.sort(counts, axis=1)[:, [BUCKETS // 4, BUCKETS // 2, 3 * BUCKETS // 4]]
    code = (counts[:, :, None] > quartile[:, None, :]).sum(2).astype(np.uint8).reshape(rows, -1, 4)
    packed = code[:, :, 0] << 6 | code[:, :, 1] << 4 | code[:, :, 2] << 2 | code[:, :, 3]
    size = np.minimum(np.log1p(np.diff(offsets)) / np.log(1.1), _LENGTHS).astype(np.uint8)
    return np.concatenate([size[:, None], packed], axis=1)


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One minus the difference score over its bound, for each pair of rows."""
    quarters = lambda d: (d[:, 1:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3
    apart = np.abs(quarters(x).astype(np.int64) - quarters(y).astype(np.int64))
    length = np.minimum(np.abs(x[:, 0].astype(np.int64) - y[:, 0]) * _LENGTH_STEP, _LENGTH_MOST)
    return 1.0 - (_APART[apart].sum((1, 2)) + length) / (_APART[-1] * BUCKETS + _LENGTH_MOST)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cell, tail, id, text) in such an order, by partition, that each row's next document follows it.

    Ids are cut into ranges. The first document of each range is repeated, as its tail, after the last one of the range
    above; that of the highest range after the lowest. So the texts move once.
    """
    lowest = -(1 << 63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("rank"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ranks = rows.select("rank", F.col("rank").cast("double").alias("place"))
    n = ranks.count()
    wanted = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    edges = sorted(set(ranks.approxQuantile("place", [i / wanted for i in range(1, wanted)], 0.25 / wanted))) if wanted > 1 else []
    cut = Bucketizer(splits=[float("-inf"), *(edges or [0.0]), float("inf")], inputCol="place", outputCol="cell")
    heads = cut.transform(ranks).groupBy("cell").agg(F.max("rank").alias("rank")).orderBy("cell").collect()
    # Not more rows than ranges, whatever the table's size.
    tails = [(h.rank, heads[i + 1 - len(heads)].cell) for i, h in enumerate(heads)]
    tails = docs.sparkSession.createDataFrame(tails, "rank long, to double")
    celled = cut.transform(rows.withColumn("place", F.col("rank").cast("double"))).select("cell", F.lit(False).alias("tail"), "rank", "id", "text")
    moved = celled.join(F.broadcast(tails), "rank").select(F.col("to").alias("cell"), F.lit(True).alias("tail"), "rank", "id", "text")
    every = celled.union(moved).withColumn("tie", F.xxhash64("text"))
    return every.repartition("cell").sortWithinPartitions("cell", "tail", F.desc("rank"), "tie").select("cell", "tail", "id", "text")


def edited_by_next(docs: DataFrame, part: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with the digests of its text, its edited text and the next document, by descending id.

    In the edited text the last floor(n_chars / ``part``) code points are the first as many of the next document. Result:
    (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    """
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_chars", T.LongType()),
        *(T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")),
        *(T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            for some in slices(batch, "text"):
                cell, tail, text = some.column(0).to_pylist(), some.column(1).to_pylist(), some.column(3).to_pylist()
                digest = digests(some.column(3))
                ids, own, after, out, edited = [], [], [], [], []
                for i, c in enumerate(cell):
                    if waiting and waiting[0] == c:
                        old = waiting[2]
                        size = len(old) // part
                        ids.append(waiting[1])
                        own.append(waiting[3])
                        after.append(digest[i])
                        out.append(len(old))
                        edited.append(old[:len(old) - size] + text[i][:size])
                    # A tail ends its range; more of them repeat its id.
                    waiting = None if tail[i] else (c, some.column(2)[i], text[i], digest[i])
                if ids:
                    changed = digests(pa.array(edited, pa.string()))
                    own, after = np.stack(own), np.stack(after)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([x.as_py() for x in ids], some.column(2).type), pa.array(out, pa.int64()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
                        pa.array([x.tobytes().hex() for x in own]), pa.array([x.tobytes().hex() for x in changed]),
                        pa.array(likeness(own, changed)), pa.array(likeness(own, after))], schema.names)

    return with_next(docs, id_col, text_col).mapInArrow(run, schema).withColumnRenamed("id", id_col)
