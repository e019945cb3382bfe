"""Vector best-fit packing of tokenised documents into sequences.

Every piece asks for tokens, a place among the documents of a sequence, and attention cost (its length squared).
Pieces go, longest first, into the open sequence that can take all three and scores best: the highest weighted
dot product of what is asked and what is left, or the smallest weighted norm of what would be left.

Pieces are dealt by a hash into groups of bounded size and each group is packed by one task, so that a sequence
never spans groups; a group wastes less than one sequence beyond its own best fit.

Nulls: a null text is the empty text, which is one piece with the end token alone; a null id is kept. Repeated
rows are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from inplay.llm.bpe import byte_symbols
from inplay.llm.common import slices, stored

#: Pieces in a group, on average. It bounds a task's memory and time.
GROUP_PIECES = 8192


class WordIds(dict):
    """Ids of words, as 32-bit integers, by the tokenizers library; encoded when first asked for.

    The tokenizer drops white space and joins nothing across it, so a text's ids are those of its words. That words
    are remembered up to ``remembered``, of at most ``remembered_bytes``, bounds memory and changes no result.
    """

    remembered, remembered_bytes = 500_000, 64

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.symbols = dict(enumerate(byte_symbols()))

    def __missing__(self, word: bytes) -> bytes:
        if word[-1:] in (b".", b",") and word[-2:-1].isalpha():
            ids = self[word[:-1]] + self[word[-1:]]
        elif shown := self.letters(word):
            # Letters alone need no splitting; the library's model gets them as after its own first steps.
            ids = array("I", [t.id for t in self.tokenize(shown)]).tobytes()
        else:
            ids = array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        if len(word) <= self.remembered_bytes:
            self[word] = ids
        return ids

    def letters(self, word: bytes) -> str:
        """The word as the model wants it if it is nothing but letters, which are lowered one by one; else nothing."""
        if word.isalpha():
            return word.lower().decode()
        text = word.decode()
        if not text.isalpha() or not unicodedata.is_normalized("NFC", text):
            return ""
        low = "".join(map(str.lower, text))
        return low.encode().decode("latin-1").translate(self.symbols) if low.isalpha() else ""

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as 32-bit integers."""
        if len(self) > self.remembered:
            self.clear()
        return [b"".join(map(self.__getitem__, t.split())) for t in texts]


_loaded: dict[str, WordIds] = {}


def pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): each document's ids and ``end_id``, cut only beyond ``capacity``.

    ``ids`` holds the piece's ids as little-endian 32-bit integers.
    """
    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    fields += [("ids", T.BinaryType())] if with_ids else []
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(*f) for f in fields)])
    last = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = WordIds(path)
        words = _loaded[path]
        for batch in batches:
            for part in slices(batch, "text"):
                row, piece, start, length, crc, raw = [], [], [], [], [], []
                for i, ids in enumerate(words.encode(part.column(1).fill_null("").cast(pa.binary()).to_pylist())):
                    ids += last
                    for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[a:a + 4 * capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(a // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        raw.append(own)
                columns = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                           *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                columns += [pa.array(raw, pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, ["id", *(n for n, _ in fields)])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def best_fit(length: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float],
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; ``length`` must not exceed the capacities.

    ``capacity`` and ``weights`` are of tokens, documents and attention cost. Ties go to the oldest sequence.
    """
    need = np.stack([np.ones(len(length)), 1 / capacity[1] * np.ones(len(length)), length.astype(float) ** 2 / capacity[2]], 1)
    need[:, 0] = length / capacity[0]
    order = np.argsort(-length, kind="stable")
    left = np.empty((3, len(length)))
    bins = np.empty(len(length), np.int64)  # the open sequences' numbers, beside ``left``
    w = np.array(weights, float)[:, None]
    sequence, offset, used = np.empty(len(length), np.int64), np.empty(len(length), np.int64), np.zeros(len(length), np.int64)
    n = made = 0
    least = need.min(axis=0) if len(length) else None
    tight = 1e-12  # capacities are fractions here, and must not be missed by rounding
    for i in order.tolist():
        ask = need[i][:, None]
        best = -1
        if n:
            after = left[:, :n] - ask
            score = (w * after * after).sum(0) if rule == "norm" else -(w * left[:, :n] * ask).sum(0)
            score[(after < -tight).any(0)] = np.inf
            best = int(score.argmin())
            if score[best] == np.inf:
                best = -1
        if best < 0:
            best, n = n, n + 1
            left[:, best], bins[best] = 1.0, made
            made += 1
        left[:, best] -= need[i]
        at = bins[best]
        sequence[i], offset[i] = at, used[at]
        used[at] += length[i]
        if (left[:, best] < least - tight).any():  # nothing fits any more
            left[:, best:n - 1], bins[best:n - 1] = left[:, best + 1:n].copy(), bins[best + 1:n].copy()
            n -= 1
    return sequence, offset


def pack(rows: DataFrame, capacity: int = 4096, max_documents: int | None = None, max_cost: float | None = None,
         weights: tuple[float, float, float] = (1.0, 1e-4, 1e-4), rule: str = "norm") -> DataFrame:
    """``rows`` of ``pieces`` with ``sequence_id`` and ``offset``.

    ``max_documents`` and ``max_cost`` (the sum of squared lengths) bound a sequence as well; without them they are
    as large as a full sequence can make them. No piece may ask for more than a whole sequence has.
    """
    rows = stored(rows, "pieces")
    bounds = (float(capacity), float(max_documents or capacity), float(max_cost or capacity ** 2))
    groups = max(1, -(-rows.count() // GROUP_PIECES))
    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = rows.columns

    def run(key: tuple, group: pa.Table) -> pa.Table:
        # The order in which rows arrive must not matter, or a retried task would differ from the first.
        group = group.sort_by([(names[0], "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        sequence, offset = best_fit(group["length"].to_numpy(), bounds, weights, rule)
        return group.select(names).append_column("sequence_id", pa.array(sequence + (key[0].as_py() << 32))).append_column("offset", pa.array(offset))

    dealt = rows.withColumn("_group", F.pmod(F.xxhash64(names[0], "piece", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(run, schema)
