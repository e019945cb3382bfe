"""A quality classifier: a byte-level convolutional network in numpy over overlapping chunks of whole texts.

Every byte has a learned vector; filters over ``WIDTH`` bytes are learned on them. A text is cut into chunks of two
blocks of ``BLOCK`` bytes that overlap by one block, so every byte lies in a chunk. A filter's value in a chunk is its
largest there. A hidden layer reads a chunk's values; over all chunks of a text, its largest and its mean activations
are combined into one probability. What a filter gives for four bytes is a sum of two table rows, one for each pair of
bytes, so a text costs two table reads a byte and is never held as an array of activations but for a small slice.

The network is fitted by Adam on about ``fit_rows`` labelled texts of at most ``fit_bytes`` bytes, drawn by a hash of
the id, as many of either label if there are; the loss weighs them back to their share. Fitting is seeded and takes the
texts in a fixed order. Scoring reads every text whole.

Defined cases: a null or empty text is one chunk without bytes. Without labelled texts of both labels the score is
the share of label 1, or 0.5 without any. A null label teaches nothing; an id with several labels teaches each.
Repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inplay.llm.common import slices, text_bytes

#: Bytes that a filter sees; it is a sum of tables for pairs of bytes, so it is even.
WIDTH = 4
BLOCK = 128
_VECTOR, _FILTERS, _HIDDEN = 8, 32, 16
#: Stands for the bytes after a text's end.
_END = 256
#: Bytes whose activations are held at once.
_SLICE = 1 << 15


@dataclass
class Network:
    """Parameters: byte vectors, filters with their bias, hidden layer, and the last weights."""

    vectors: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    last: np.ndarray
    last_bias: np.ndarray

    @staticmethod
    def random(seed: int) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        return Network(draw(_END + 1, _VECTOR, scale=0.5), draw(WIDTH, _VECTOR, _FILTERS, scale=(WIDTH * _VECTOR) ** -0.5), np.zeros(_FILTERS, np.float32),
                       draw(_FILTERS, _HIDDEN, scale=_FILTERS ** -0.5), np.zeros(_HIDDEN, np.float32), draw(2 * _HIDDEN, scale=0.1), np.zeros(1, np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.hidden, self.hidden_bias, self.last, self.last_bias]

    def tables(self) -> np.ndarray:
        """What each byte adds to each filter at each of its places."""
        return np.einsum("bv,kvf->kbf", self.vectors, self.filters)

    def pair_tables(self) -> list[np.ndarray]:
        """The same for each two bytes that follow each other."""
        one = self.tables()
        return [(one[k][:, None] + one[k + 1][None]).reshape(-1, _FILTERS) for k in range(0, WIDTH, 2)]

    def combined(self, pooled: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Probabilities of texts from their chunks' values; ``first`` is each text's first chunk. What the gradient needs comes along."""
        inner = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        count = np.diff(first, append=len(pooled))[:, None]
        both = np.concatenate([np.maximum.reduceat(inner, first), np.add.reduceat(inner, first) / count], axis=1)
        return 1 / (1 + np.exp(-(both @ self.last + self.last_bias[0]))), inner, both, count


def chunk_counts(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and chunks of texts of these sizes."""
    blocks = np.maximum(1, -(-size // BLOCK))
    return blocks, np.maximum(1, blocks - 1)


def pooled_chunks(network: Network, pairs: list[np.ndarray], data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The filters' values in all chunks of all texts, and each text's first chunk."""
    size = np.diff(offsets)
    blocks, chunks = chunk_counts(size)
    first_block = np.cumsum(blocks) - blocks
    # Texts lie one after the other, each with the ends that its last filters see; an empty one has a place of its own.
    room = np.maximum(size, 1)
    start = np.cumsum(room + WIDTH) - (room + WIDTH)
    text = np.full(int((room + WIDTH).sum()), _END, np.int32)
    text[np.repeat(start - offsets[:-1], size) + np.arange(len(data))] = data
    pair = text[:-1] * (_END + 1) + text[1:]
    own = np.repeat(np.arange(len(size)), blocks)
    block_start = start[own] + (np.arange(len(own)) - first_block[own]) * BLOCK
    block_end = np.minimum(block_start + BLOCK, (start + room)[own])
    values = np.empty((len(own), _FILTERS), np.float32)
    step = _SLICE // BLOCK
    for a in range(0, len(own), step):
        s, e = block_start[a:a + step], block_end[a:a + step]
        low, high = s[0], e[-1]
        z = pairs[0][pair[low:high]]
        for k in range(1, WIDTH // 2):
            z += pairs[k][pair[low + 2 * k:high + 2 * k]]
        # Between two blocks of different texts lie places that belong to none.
        edges = np.stack([s - low, e - low], axis=1).ravel()
        values[a:a + step] = np.maximum.reduceat(z, edges[:-1])[::2]
    values = np.maximum(values + network.bias, 0)
    first = np.cumsum(chunks) - chunks
    of = np.repeat(np.arange(len(size)), chunks)
    left = first_block[of] + np.arange(len(of)) - first[of]
    return np.maximum(values[left], values[np.minimum(left + 1, (first_block + blocks - 1)[of])]), first


def scores(network: Network, pairs: list[np.ndarray], column: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(column)
    return network.combined(*pooled_chunks(network, pairs, data, offsets))[0].astype(float)


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, rounds: int = 16, batch: int = 64, rate: float = 0.004, seed: int = 7) -> Network:
    """A network fitted to ``texts`` with 0/1 ``labels``; gradients flow through each filter's largest place in a chunk."""
    network, rng = Network.random(seed), np.random.default_rng(seed)
    network.last_bias[:] = np.log((weights @ labels + 1) / (weights @ (1 - labels) + 1))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    chunked = [_chunks(t) for t in texts]
    steps = 0
    for turn in range(rounds):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            some = order[a:a + batch]
            x = np.concatenate([chunked[i] for i in some])
            count = np.array([len(chunked[i]) for i in some])
            gradients = _gradients(network, x, np.cumsum(count) - count, labels[some], weights[some])
            steps += 1
            for p, g, (m, v) in zip(network.parameters(), gradients, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (1 - turn / rounds) * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)
    return network


def _chunks(text: bytes) -> np.ndarray:
    """The chunks of a text, one row each, with the bytes that its last filters see."""
    n = int(chunk_counts(np.array([len(text)]))[1][0])
    padded = np.full((n + 1) * BLOCK + WIDTH - 1, _END, np.int16)
    padded[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, 2 * BLOCK + WIDTH - 1)[::BLOCK][:n]


def _gradients(network: Network, x: np.ndarray, first: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    pairs = network.pair_tables()
    # Chunks by slices: the activations of a slice are gone once their largest places are known.
    top, where = np.empty((len(x), _FILTERS), np.float32), np.empty((len(x), _FILTERS), np.int64)
    for a in range(0, len(x), 128):
        some = x[a:a + 128].astype(np.int32)
        pair = some[:, :-1] * (_END + 1) + some[:, 1:]
        n = some.shape[1] - WIDTH + 1
        z = pairs[0][pair[:, :n]]
        for k in range(1, WIDTH // 2):
            z += pairs[k][pair[:, 2 * k:2 * k + n]]
        # A filter must begin inside the text, or on an empty text's one place.
        z[:, 1:][some[:, 1:n] == _END] = -np.inf
        where[a:a + 128] = z.argmax(1)
        top[a:a + 128] = z.max(1)
    pooled = np.maximum(top + network.bias, 0)
    p, inner, both, count = network.combined(pooled, first)
    error = (weights * (p - labels) / weights.sum()).astype(np.float32)
    d_both = error[:, None] * network.last[None]
    of = np.repeat(np.arange(len(first)), count[:, 0])
    largest = (inner == both[of, :_HIDDEN]) & (inner > 0)
    ties = np.maximum(np.add.reduceat(largest.astype(np.float32), first), 1)
    d_inner = (d_both[:, _HIDDEN:] / count)[of] * (inner > 0) + largest * (d_both[:, :_HIDDEN] / ties)[of]
    d_pooled = (d_inner @ network.hidden.T) * (pooled > 0)
    filters = np.arange(_FILTERS)
    d_tables = np.stack([np.bincount((np.take_along_axis(x, where + k, 1).astype(np.int64) * _FILTERS + filters).ravel(), d_pooled.ravel(), (_END + 1) * _FILTERS)
                         .reshape(-1, _FILTERS) for k in range(WIDTH)]).astype(np.float32)
    return [np.einsum("kbf,kvf->bv", d_tables, network.filters), np.einsum("kbf,bv->kvf", d_tables, network.vectors), d_pooled.sum(0),
            pooled.T @ d_inner, d_inner.sum(0), error @ both, error.sum(keepdims=True)]


def held_out(id_col: str, folds: int = 5, fold: int = 0) -> Column:
    """Whether the row belongs to the fold that nothing is learnt from; a row without an id does."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
            fit_rows: int = 2400, fit_bytes: int = 1 << 15) -> Network | float:
    """The network, or the share of label 1 where there is nothing to tell apart.

    ``labels`` (id, label) are drawn before they meet the texts, so what is joined and collected is bounded.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), (F.col(label_col) == 1).cast("int").alias("label"))
    count = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(count.values())
    cells = 1 << 30
    share = F.create_map(*(F.lit(v) for k, n in sorted(count.items()) for v in (k, min(cells, fit_rows * cells // (2 * n))))) if count else F.lit(None)
    if len(count) < 2:
        return count.get(1, 0) / total if total else 0.5
    drawn = known.where(F.pmod(F.xxhash64("id"), F.lit(cells)) < share[F.col("label")])
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    rows = texts.join(F.broadcast(drawn), "id").select("id", "label", F.coalesce("text", F.lit(b"")).alias("text")).where(F.octet_length("text") <= fit_bytes)
    sample = sorted(map(tuple, rows.collect()))
    y = np.array([r[1] for r in sample], np.float32)
    if not 0 < y.sum() < len(y):
        return count[1] / total
    # Each label weighs as much as its share of all labels.
    weight = {k: n / total / max(1, (y == k).sum()) for k, n in count.items()}
    weights = np.array([weight[int(k)] for k in y], np.float32)
    return fit([bytes(r[2]) for r in sample], y, weights / weights.mean())


def score(network: Network | float, text_col: str = "text") -> Column:
    """A column of probabilities of label 1."""
    pairs = None if isinstance(network, float) else network.pair_tables()

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            if pairs is None:
                yield pa.array(np.full(len(column), network), pa.float64())
                continue
            rows = pa.RecordBatch.from_arrays([column], ["text"])
            yield pa.array(np.concatenate([np.zeros(0), *(scores(network, pairs, part.column(0)) for part in slices(rows, "text", 1 << 20))]), pa.float64())

    return run(F.col(text_col).cast("string"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", cut: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) of every row; ``predicted`` is 1 from the score ``cut`` on. Learns from the rows that are not held out."""
    network = learned(docs, labels.where(~held_out(id_col)), id_col, text_col, label_col)
    found = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score(network, text_col).alias("score"))
    return found.select(id_col, "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"))
