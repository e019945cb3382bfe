"""What the text operators share: tables in the shared folder and hashed words of Arrow columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, types as T

from inplay.session import shared_folder

#: Words are runs of other characters than these: space, tab, line feed, vertical tab, form feed, return.
SPACES = b" \t\n\x0b\x0c\r"
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
#: Words above so many bytes are hashed one by one.
_LONG = 48
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are summed at once, and powers of the base and of its inverse for so many and a word.
_RUN = 1 << 16
_ZERO = np.zeros(1, np.uint64)
_POWERS = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(_RUN + _LONG, x, np.uint64)])) for x in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64)))]
_folders: dict[str, str] = {}
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def _home(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = f"{shared_folder(spark)}/llm-{app}"
    return _folders[app]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A folder of its own for what ``stored`` writes inside; it is deleted at the end, and nothing else is.

    What goes on afterwards has to be written with ``keep``. Scopes may lie in each other and in several threads.
    """
    folder = f"{_home(spark)}/scratch-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        delete(spark, folder)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this module has written, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def kept_path(spark: SparkSession, name: str, keep: bool = True) -> str:
    """A path for a new table: in the folder of the scope, or outside all scopes."""
    return f"{(None if keep else _scratch.get()) or _home(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written as a table in the shared folder and read again; this cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = kept_path(spark, name, keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` has not, made from ``name``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def carried(docs: DataFrame, columns: Sequence[str]) -> list[T.StructField]:
    """The field of a struct ``carry`` of these columns, if there are any."""
    return [T.StructField("carry", T.StructType([docs.schema[c] for c in columns]))] if columns else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch | pa.Table, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with about ``most`` bytes of text, one row at least; bounds what numpy holds at once."""
    for part in batch.to_batches() if isinstance(batch, pa.Table) else [batch]:
        if not part.num_rows:
            continue
        column = part.column(part.schema.get_field_index(text))
        ends = text_bytes(column)[1][1:]
        cell = ends // most
        cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), part.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield part.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and where each row begins (one more entry than rows); a null row is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words:
    """Words of all rows of a column.

    ``starts``, ``ends``: byte positions in ``data``; ``first``: index of each row's first word, with one entry
    more than rows.
    """

    def __init__(self, column: pa.Array):
        self.data, self.offsets = data, offsets = text_bytes(column)
        solid = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begin, stop = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1] | edge[1:-1]
        stop[:-1] &= ~solid[1:] | edge[1:-1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        data, starts, length = self.data, self.starts, self.ends - self.starts
        h = np.full(len(starts), np.uint64(seed * 2 + 1), np.uint64) + length.astype(np.uint64)
        long = np.flatnonzero(length > _LONG)
        left = np.flatnonzero(length <= _LONG) if len(long) else np.arange(len(starts))
        # h * B ** n + sum(byte[i] * B ** (n - 1 - i)), from running sums over runs of bytes. B is odd, so it has an inverse.
        cuts = np.searchsorted(starts[left], np.arange(0, len(data) + _RUN, _RUN)).tolist()
        up, down = _POWERS
        for run, (a, b) in enumerate(zip(cuts, cuts[1:])):
            some = left[a:b]
            if len(some):
                part = data[run * _RUN:(run + 1) * _RUN + _LONG]
                sums = np.concatenate([_ZERO, np.cumsum(part * down[:len(part)])])
                begin = starts[some] - run * _RUN
                end = begin + length[some]
                h[some] = h[some] * up[length[some]] + (sums[end] - sums[begin]) * up[end - 1]
        for i in long.tolist():
            h[i] = np.uint64(xxhash.xxh64_intdigest(data[starts[i]:self.ends[i]].tobytes(), seed))
        return mix(h)

    def windows(self, hashed: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Rabin-Karp hashes of all runs of ``width`` words that lie in one row, with the index of their first word."""
        row_end = np.repeat(self.first[1:], np.diff(self.first))
        at = np.flatnonzero(np.arange(len(hashed)) + width <= row_end)
        return (mix(rolled(hashed, width)[at]) if len(at) else np.zeros(0, np.uint64)), at


def rolled(h: np.ndarray, width: int) -> np.ndarray:
    """sum(h[i + j] * B ** (width - 1 - j)) mod 2 ** 64 for every i, from runs whose lengths are powers of two."""
    out, done, run, length, powers = None, 0, h, 1, 0
    while width >> powers:
        if width >> powers & 1:
            if out is None:
                out, done = run, length
            else:
                n = max(0, len(h) - done - length + 1)
                # The run goes in front of what is there, so what is there keeps its powers.
                out, done = run[:n] * _power(done) + out[length:length + n], done + length
        powers += 1
        n = max(0, len(h) - 2 * length + 1)
        run, length = run[:n] * _power(length) + run[length:length + n], 2 * length
    return out


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def sql_crc32(numbers: str) -> str:
    """SQL for the unsigned CRC-32 of a list of byte values, for checking: bit by bit, as the polynomial has it."""
    return (f"xor(list_reduce({numbers}, lambda c, x: list_reduce(range(8), lambda d, i: CASE WHEN d & 1 = 1 THEN xor(3988292384, d >> 1) "
            "ELSE d >> 1 END, xor(c, x)), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))")
