"""BPE encoding and decoding with batched numpy merge rounds.

Distinct words are merged together: the symbols of many words lie in one flat array, the rank of each adjacent
pair is found by binary search over sorted pair keys, and each round merges the lowest-ranked pair of every word.
A worker remembers the ids of frequent words; a text is then a join of remembered ids.

Nulls: a null text is encoded as the empty text (no ids). Repeated rows stay repeated. An empty table gives an
empty result. Columns other than the id and the text are not carried along. Texts of any length are taken whole.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from inplay.llm.common import slices


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in names)
    return [x for _, x in sorted((names | {b: chr(256 + i) for i, b in enumerate(hidden)}).items())]


class Bpe:
    """A tokenizer file's vocabulary and merges, and the ids of words seen so far.

    The tokenizer drops white space and joins nothing across it, so a text's ids are those of its words. That words
    are remembered up to ``remembered``, of at most ``remembered_bytes``, bounds memory and changes no result.
    """

    remembered, remembered_bytes = 250_000, 64

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.tokens = [""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        self.shown = pa.array(self.tokens, pa.string())
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.width = np.int64(len(self.tokens))
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.known: dict[bytes, bytes] = {}
        self.stops = dict(zip((b".", b","), self.encode_words([b".", b","])))

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (past the last rank if it is no merge) and its place in the sorted keys."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys)), at

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces (none is empty) in one array, and the number of ids of each."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(size)
        ids = self.inner[flat]
        ids[ends - 1] = self.last[flat[ends - 1]]
        word = np.repeat(np.arange(len(pieces)), size)
        done_ids, done_words = [], []
        none = len(self.keys)
        while len(ids):
            rank = np.full(len(ids), none, np.int64)
            place = np.zeros(len(ids), np.int64)
            rank[:-1], place[:-1] = self.ranks_of(ids[:-1], ids[1:])
            rank[:-1][word[1:] != word[:-1]] = none
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, begin)
            length = np.diff(np.concatenate([begin, [len(ids)]]))
            open_ = np.repeat(least < none, length)
            done_ids.append(ids[~open_])
            done_words.append(word[~open_])
            hit = (rank == np.repeat(least, length)) & open_
            # Of overlapping pairs (as in "aaa") the first, third, ... are merged.
            if (hit[1:] & hit[:-1]).any():
                at = np.arange(len(hit))
                run = np.maximum.accumulate(np.where(hit & ~np.concatenate([[False], hit[:-1]]), at, 0))
                hit &= (at - run) % 2 == 0
            ids = np.where(hit, self.made[place], ids)
            keep = open_ & ~np.concatenate([[False], hit[:-1]])
            ids, word = ids[keep], word[keep]
        words = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
        order = np.argsort(words, kind="stable")
        ids = np.concatenate(done_ids)[order] if done_ids else np.zeros(0, np.int64)
        return ids.astype(np.int32), np.bincount(words, minlength=len(pieces))

    def pieces(self, word: bytes) -> list[bytes | int]:
        """What a run of text without ASCII white space is split into; special tokens as their ids."""
        text = word.decode("utf-8")
        out: list[bytes | int] = []
        for part in self.cut.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                if part.isascii():
                    part = part.lower()
                else:
                    part = unicodedata.normalize("NFC", part)
                    # Letters are lowered one by one, without regard to their neighbours.
                    part = "".join(c.lower() for c in part) if "Σ" in part else part.lower()
                out += [x.encode() for x in self.pattern.findall(part)]
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as 32-bit integers."""
        split = [self.pieces(w) for w in words]
        distinct = list(dict.fromkeys(p for s in split for p in s if isinstance(p, bytes)))
        ids, count = self.merge(distinct) if distinct else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        raw, ends = ids.tobytes(), (np.cumsum(count) * 4).tolist()
        found = {p: raw[a:b] for p, a, b in zip(distinct, [0, *ends], ends)}
        return [b"".join(found[p] if isinstance(p, bytes) else p.to_bytes(4, "little") for p in s) for s in split]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as 32-bit integers."""
        split = [t.split() for t in texts]
        if len(self.known) > self.remembered:
            self.known = {}
        known, stops = self.known, self.stops
        fresh = list(set().union(*split).difference(known))
        # Case and one stop after a letter change nothing else in a word; special tokens keep their case.
        bare = [w[:-1] if w[-1:] in stops and w[-2:-1].isalpha() else w for w in fresh]
        cores = [w if b"<|" in w else w.lower() for w in bare]
        new = list(set(cores).difference(known))
        found = dict(zip(new, self.encode_words(new))) if new else {}
        coded = [(found[c] if c in found else known[c]) + (stops[w[-1:]] if len(b) < len(w) else b"") for w, b, c in zip(fresh, bare, cores)]
        own = {w: ids for w, ids in zip(fresh, coded) if len(w) > self.remembered_bytes}
        known.update(zip(fresh, coded) if not own else [(w, ids) for w, ids in zip(fresh, coded) if w not in own])
        look = known.__getitem__ if not own else lambda w: known[w] if w in known else own[w]
        return [b"".join(map(look, words)) for words in split]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The tokens of each row of ids, joined by one space; they are spelled out for about a million ids at once."""
        size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        ends = np.cumsum(size)
        cuts = [0, *(np.flatnonzero(ends[1:] >> 20 != ends[:-1] >> 20) + 1).tolist(), len(ids)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            offsets = pa.array(np.concatenate([[0], np.cumsum(size[a:b])]).astype(np.int32))
            out.append(pc.binary_join(pa.ListArray.from_arrays(offsets, self.shown.take(ids.slice(a, b - a).flatten())), " "))
        return pa.concat_arrays(out)


_loaded: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """The tokenizer of a file, read once in a worker."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: str = "") -> DataFrame:
    """(id, ids[, decoded]): token ids of every whole text, and what they decode to, if a name for it is given.

    ``path`` is read by the executors.
    """
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           *([T.StructField(decoded, T.StringType())] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = bpe.encode(part.column(1).fill_null("").cast(pa.binary()).to_pylist())
                ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) // 4
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, *([bpe.decode(lists)] if decoded else [])], schema.names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(ids: Column, path: str) -> Column:
    """The text that token ids stand for: their tokens, joined by one space, as the file names no decoder. Null ids are none."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return loaded(path).decode(column)

    return run(ids)
