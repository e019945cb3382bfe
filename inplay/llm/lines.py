"""Fuzzy line deduplication: SimHash of normalised lines, pigeonhole blocks, edit similarity, one occurrence kept.

Lines are the same node if they are equal but for the case of A-Z and white space. For its SimHash a line is normalised
further: digits become 0, other ASCII than letters and digits separates words. Features are pairs of neighbouring words, or
runs of three bytes in lines of few words. They are dealt into blocks, more in longer lines, and each block is a SimHash
of 32 bits of its own features: an edit touches the blocks of few features, so of two near lines a block is the same if
there are fewer edits than blocks, and often one whose features differ little. Lines near the limit between two numbers
of blocks are cut in both ways. Blocks of very few features are no keys unless the line has none else.

Nodes that share a block are compared with the bucket's first; then, only in buckets that still hold several components,
nodes of different components, block by block, until no two components are left that near lines connect. A pair is linked if the edit similarity of its lines,
1 - distance / longer length in code points, is at least ``threshold``. Of the lines of a connected group the first, by
id and place, stays.

Defined cases: lines without letters and digits stay. A null text stays null. Rows without an id stay as they are and
take no part. Rows that share an id are one document: a place that one keeps, all keep. Lines of any length are read
whole. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from inplay.llm.common import Words, carried, mix, scratch, slices, stored, text_bytes
from inplay.llm.components import components
from inplay.llm.minhash import open_members

#: Words from which on a line takes the next number of blocks; the numbers are powers of two from ``BLOCKS`` on.
LEVELS = (11, 48, 140)
BLOCKS = 4
#: Lines of at most so many words are cut by their bytes; those around this number both ways.
FEW_WORDS = 8
#: Features that a block has at least, of words and of bytes.
LEAST = (2, 2)
#: How far two near lines differ in their numbers of words, for lines at a limit.
_SLACK = 0.12
#: Bits of the filter that picks lines to be verified. It is of fixed size; what it lets through too much does no harm.
FILTER_BITS = 1 << 25
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a line as nodes take it: small letters, control characters as spaces.
_FOLD = np.array([10 if i == 10 else 32 if i < 32 or i == 127 else ord(chr(i).lower()) if i < 128 else i for i in range(256)], np.uint8)
#: Bytes of a line as its SimHash takes it.
_NORMAL = np.array([i if i >= 128 else ord(chr(i).lower()) if chr(i).isalpha() else 48 if chr(i).isdigit() else 10 if i == 10 else 32
                    for i in range(256)], np.uint8)


def split_lines(column: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lines of all texts as one array, their bytes replaced by ``table``, with their rows and their places in the text."""
    data, offsets = text_bytes(column)
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(offsets, breaks, side="right") - 1
    # A line ends before a break or at the end of its text; every text has one line at least.
    ends = np.concatenate([breaks, offsets[1:]])
    owner = np.concatenate([row, np.arange(len(offsets) - 1)])
    order = np.lexsort((ends, owner))
    owner, ends = owner[order], ends[order]
    first = np.searchsorted(owner, np.arange(len(offsets) - 1))
    # Breaks stay in the data as white space at a line's begin.
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    begins[first] = offsets[:-1]
    raw = pa.py_buffer(table[data])
    cut = np.concatenate([begins, offsets[-1:]]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(cut), raw]), owner, np.arange(len(owner)) - first[owner]


def majority(group: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The groups, how many distinct features each has, and the bits that more than half of these have. Both inputs have 32 bits."""
    key = np.sort(group.astype(np.uint64) << np.uint64(32) | feature & np.uint64(0xFFFFFFFF))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]]
    own = key >> np.uint64(32)
    begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])[:len(key)])
    size = np.diff(begin, append=len(key))
    # Ones are counted in bytes, eight of them in an integer, so at most 255 features go into one sum.
    parts = -(-size // 255)
    owner = np.repeat(np.arange(len(begin)), parts)
    at = begin[owner] + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts))
    out = np.zeros(len(begin), np.uint64)
    low32 = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    step = 1 << 14
    cuts = [*np.searchsorted(owner, np.arange(0, len(begin), step)).tolist(), len(owner)]
    for k, (c, d) in enumerate(zip(cuts, cuts[1:])):
        low, high = at[c], at[d] if d < len(at) else len(key)
        bits = np.unpackbits(low32[low:high].view(np.uint8)).view(np.uint64).reshape(-1, 4)
        sums = np.add.reduceat(bits, at[c:d] - low, axis=0).view(np.uint8)
        mine = owner[c:d] - k * step
        fresh = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        ones = sums.astype(np.int32) if len(fresh) == len(mine) else np.add.reduceat(sums, fresh, axis=0, dtype=np.int32)
        half = size[k * step:(k + 1) * step, None]
        out[k * step:(k + 1) * step] = np.packbits(2 * ones > half, axis=1).view(np.uint32)[:, 0]
    return own[begin], size, out


def _cut(line: np.ndarray, spread: np.ndarray, feature: np.ndarray, level: np.ndarray, kind: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks as keys, with their lines, and each line's number of distinct features. ``spread`` deals a feature of a line to one of the blocks that the line's ``level`` has."""
    count = np.uint64(BLOCKS) << level.astype(np.uint64)
    block = (spread >> np.uint64(32)) % count[line]
    # 20 bits of line, 6 of block; lines come in runs of at most so many.
    group, size, value = majority(line.astype(np.uint64) << np.uint64(6) | block, feature)
    owner, block = (group >> np.uint64(6)).astype(np.int64), group & np.uint64(63)
    most = np.zeros(len(level), np.int64)
    np.maximum.at(most, owner, size)
    ok = size >= np.minimum(least, most[owner])
    key = value | block << np.uint64(32) | level[owner].astype(np.uint64) << np.uint64(40) | np.uint64(kind) << np.uint64(48)
    return key[ok], owner[ok], np.bincount(owner, size, len(level)).astype(np.int64)


def block_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all lines with the lines they belong to, from the normalised lines' words."""
    hashed, first = words.hashes(), words.first
    keys, owners = [], []
    for a in range(0, len(first) - 1, 1 << 18):
        cut = first[a:a + (1 << 18) + 1]
        for key, owner in _line_keys(hashed[cut[0]:cut[-1]], cut - cut[0], words, cut[0]):
            keys.append(key)
            owners.append(owner + a)
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return key[order].view(np.int64), owner[order]


def _line_keys(hashed: np.ndarray, first: np.ndarray, words: Words, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    count = np.diff(first)
    if not len(hashed):
        return
    # Pairs of neighbours, the first and the last word with the line's edge; dealt by the word in front.
    line = np.repeat(np.arange(len(count)), count)
    before = np.concatenate([[0], hashed[:-1]]).astype(np.uint64)
    before[first[:-1][count > 0]] = 0
    full = np.flatnonzero(count > 0)
    last = hashed[first[1:][full] - 1]
    spread = mix(np.concatenate([before, last]) + _ODD)
    feature = mix(np.concatenate([before * _ODD + hashed, last * _ODD]))
    line = np.concatenate([line, full])
    many = count >= FEW_WORDS
    distinct = np.zeros(len(count), np.int64)
    for level, chosen in _levels(count, many):
        some = chosen[line]
        key, owner, found = _cut(line[some], spread[some], feature[some], np.full(len(count), level), 1, LEAST[0])
        distinct = np.maximum(distinct, found)
        yield key, owner
    # Lines that repeat few words have too many blocks for what they hold; they take the blocks of a shorter line as well.
    for level, chosen in _levels(distinct, many & (2 * distinct < count)):
        some = chosen[line]
        yield _cut(line[some], spread[some], feature[some], np.full(len(count), level), 1, LEAST[0])[:2]
    few = np.flatnonzero((count > 0) & (count <= FEW_WORDS + 1))
    if not len(few):
        return
    # The words of such a line with one space between, and one at either end.
    at = np.repeat(offset + first[few], count[few]) + np.arange(count[few].sum()) - np.repeat(np.cumsum(count[few]) - count[few], count[few])
    size = words.ends[at] - words.starts[at]
    text = np.full(int(size.sum() + len(size) + len(few)), 32, np.uint8)
    line_of = np.repeat(np.arange(len(few)), count[few])
    place = np.cumsum(size + 1) - size + line_of
    text[np.repeat(place - (np.cumsum(size) - size), size) + np.arange(size.sum())] = words.data[np.repeat(words.starts[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    length = np.bincount(line_of, size + 1, len(few)).astype(np.int64) + 1
    line = np.repeat(few, length)
    wide = text.astype(np.uint64)
    gram = wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16)
    inside = line[:-2] == line[2:]
    line, gram = line[:-2][inside], gram[inside]
    grams = np.bincount(line, minlength=len(count))
    # Short lines have few blocks; they are dealt in four ways instead.
    short = grams < 32
    for seed, chosen in ((0, np.ones(len(count), bool)), (1, short), (2, short), (3, short)):
        some = chosen[line]
        if some.any():
            yield _cut(line[some], mix(gram[some] ^ mix(np.full(1, seed, np.uint64))), mix(gram[some] * _ODD + np.uint64(7)), np.where(short, 0, 1), 2 + seed, LEAST[1])[:2]


def _levels(count: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number of blocks that lines of so many words, or of nearly so many, take, and which of the ``wanted`` lines do."""
    near = [np.searchsorted(LEVELS, n, side="right") for n in (count, count * (1 + _SLACK), count / (1 + _SLACK))]
    for level in range(len(LEVELS) + 1):
        chosen = wanted & np.logical_or.reduce([n == level for n in near])
        if chosen.any():
            yield level, chosen


def distance_within(a: str, b: str, most: int, likely: bool = True) -> bool:
    """Whether the edit distance is at most ``most``.

    Of longer lines that are ``likely`` near, it is enough if keeping what their words have in common and editing the rest takes so few edits.
    """
    if abs(len(a) - len(b)) > most:
        return False
    a, b = _trimmed(a, b)
    if max(len(a), len(b)) <= most:
        return True
    if likely and len(a) > 64 and _word_edits(a, b, most) <= most:
        return True
    return _distance(a, b, most) <= most


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Both without the characters that they begin and end with alike."""
    at, end = 0, min(len(a), len(b))
    while at < end and a[at] == b[at]:
        at += 1
    back = 0
    while back < end - at and a[-1 - back] == b[-1 - back]:
        back += 1
    return a[at:len(a) - back], b[at:len(b) - back]


def _distance(a: str, b: str, most: int) -> int:
    """The edit distance, or any number above ``most`` if it is above; columns of the table are bits of an integer.

    Along the diagonal that ends in the last cell of the table distances never fall, so one above ``most`` ends the comparison.
    """
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    up, down = full, 0
    ahead = len(a) - len(b)
    for j, c in enumerate(b, 1):
        match = where.get(c, 0)
        across = ((((match & up) + up) ^ up) | match | down) & full
        plus = ((down | (across | up) ^ full) << 1 | 1) & full
        minus = (up & across) << 1
        up, down = (minus | (across | plus) ^ full) & full, plus & across
        if not j & 15 and j + ahead > 0:
            rows = (1 << j + ahead) - 1
            if (score := j + (up & rows).bit_count() - (down & rows).bit_count()) > most:
                return score
    return len(b) + up.bit_count() - down.bit_count()


def _word_edits(a: str, b: str, most: int) -> int:
    """Edits that turn ``a`` into ``b`` if words are kept and what lies between is edited: no fewer than the edit distance; above ``most`` any number.

    Words that occur once in both, or in long lines begin three words that do, are kept as far as their order is the same, and equal words next to those.
    """
    x, y = a.split(" "), b.split(" ")
    marks = [list(zip(w, w[1:], w[2:])) if min(len(x), len(y)) > 100 else w for w in (x, y)]
    once = {w for w, n in Counter(marks[1]).items() if n == 1}
    where = {w: j for j, w in enumerate(marks[1]) if w in once}
    again = Counter(marks[0])
    places = [(i, where[w]) for i, w in enumerate(marks[0]) if w in where and again[w] == 1]
    # The longest run of such words in the same order, by patience sorting.
    ends: list[int] = []
    best: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(places):
        at = bisect_left(ends, j)
        ends[at:at + 1] = [j]
        best[at:at + 1] = [k]
        back.append(best[at - 1] if at else -1)
    kept, k = [(len(x), len(y))], best[-1] if best else -1
    while k >= 0:
        kept.append(places[k])
        k = back[k]
    rest, edits, i, j = [], 0, 0, 0
    for p, q in reversed(kept):
        while i < p and j < q and x[i] == y[j]:
            i, j = i + 1, j + 1
        e, f = p, q
        while e > i and f > j and x[e - 1] == y[f - 1]:
            e, f = e - 1, f - 1
        if e > i or f > j:
            rest.append((" ".join(x[i:e]) + " " * (e > i), " ".join(y[j:f]) + " " * (f > j)))
            edits += max(map(len, rest[-1]))
        i, j = p + 1, q + 1
    # Replaced whole they may take too many edits; then the longest are edited letter by letter, until it is enough.
    for left, right in sorted(rest, key=lambda r: -max(map(len, r))):
        if edits <= most:
            break
        whole = max(len(left), len(right))
        # A long one is as much work as the lines.
        if 2 * whole > min(len(a), len(b)):
            return most + 1
        if left and right:
            edits += _distance(*_trimmed(left, right), whole) - whole
    return edits


def line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, line, h1, h2, keys) of every line with words."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("line", T.IntegerType()),
                           T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                lines, row, place = split_lines(part.column(1), _NORMAL)
                key, owner = block_keys(Words(lines))
                full = np.flatnonzero(np.bincount(owner, minlength=len(row)) > 0)
                # Edges of each line's keys; lines without keys have no words.
                offsets = np.concatenate([np.searchsorted(owner, full), [len(owner)]]).astype(np.int32)
                h1, h2 = line_hashes(folded_lines(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row[full])), pa.array(place[full].astype(np.int32)), pa.array(h1[full]), pa.array(h2[full]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(key))],
                    schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def folded_lines(column: pa.Array) -> list[bytes]:
    """The lines of all texts as nodes take them: words joined by one space."""
    lines = split_lines(column, _FOLD)[0]
    data, cut = text_bytes(lines)
    solid = data > 32
    # The first white space behind a word stays for the time being, unless it begins the next line.
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    begin = cut[:-1][cut[:-1] < cut[1:]]
    keep[begin] = solid[begin]
    cut = np.concatenate([[0], np.cumsum(keep)])[cut]
    raw = data[keep].tobytes()
    return [raw[a:b].removesuffix(b" ") for a, b in itertools.pairwise(cut.tolist())]


def line_hashes(folded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each line."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, folded)), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def line_texts(docs: DataFrame, pairs: DataFrame, text_col: str) -> DataFrame:
    """(node, line_text): the folded lines of the nodes that ``pairs`` (a, b) name; words are joined by one space."""
    wanted = stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "wanted")
    size = FILTER_BITS // 64
    place = F.pmod(F.col("node"), F.lit(FILTER_BITS))
    words = (wanted.groupBy(F.floor(place / 64).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(node, {FILTER_BITS}) % 64 as int))")).alias("bits")))
    filter_ = np.zeros(size, np.int64)
    got = words.toArrow()
    filter_[got["word"].to_numpy()] = got["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                lines = folded_lines(part.column(0))
                node = line_hashes(lines)[0]
                at = np.mod(node, FILTER_BITS)
                some = np.flatnonzero((shared.value[at // 64] >> (at % 64)) & 1)
                if len(some):
                    text = pa.array([lines[i] for i in some.tolist()], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(node[some]), text], ["node", "line_text"])

    sent = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "node long, line_text string")
    return stored(sent.groupBy("node").agg(F.min("line_text").alias("line_text")).join(wanted, "node", "left_semi"), "line-texts")


def verified(text: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose lines in ``text`` have an edit similarity of ``threshold``: 1 - distance / longer length."""
    # A bucket's first node is b in many pairs, so the pairs are dealt by a in the end, where the work is.
    met = (pairs.join(text.select(F.col("node").alias("b"), F.col("line_text").alias("y")), "b")
           .join(text.select(F.col("node").alias("a"), F.col("line_text").alias("x")), "a")
           .where(F.least(F.char_length("x"), F.char_length("y")) >= threshold * F.greatest(F.char_length("x"), F.char_length("y")) - 1e-6))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "x", 1 << 19):
                left, right = part.column(2).to_pylist(), part.column(3).to_pylist()
                most = np.array([int((1 - threshold) * max(len(x), len(y)) + 1e-9) for x, y in zip(left, right)])
                near = grams_apart(part.column(2), part.column(3)) <= 3 * most
                for k in np.flatnonzero(near).tolist():
                    near[k] = distance_within(left[k], right[k], int(most[k]))
                yield part.select(["a", "b"]).filter(pa.array(near))

    return stored(met.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")


def gram_counts(column: pa.Array) -> np.ndarray:
    """How many runs of three bytes each text has in each of 1024 classes. Only ASCII and lead bytes are taken, one for each character."""
    data, offsets = text_bytes(column)
    lead = (data & 0xC0) != 0x80
    begin = np.concatenate([[0], np.cumsum(lead)])[offsets]
    code = data[lead].astype(np.uint32)
    if len(code) < 3:
        return np.zeros((len(column), 1024), np.int32)
    owner = np.repeat(np.arange(len(column)), np.diff(begin))
    gram = ((code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA77) + code[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)) >> np.uint32(22)
    inside = owner[:-2] == owner[2:]
    return np.bincount(owner[:-2][inside] * 1024 + gram[inside], minlength=len(column) * 1024).astype(np.int32).reshape(-1, 1024)


def more_than(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """By how much the counts in a row of ``left`` and ``right`` go over the other's, in sum: the larger of both sums."""
    more = left - right
    both, apart = more.sum(1), np.abs(more).sum(1)
    return (apart + np.abs(both)) // 2


def grams_apart(left: pa.Array, right: pa.Array) -> np.ndarray:
    """For each pair of texts how many runs of three bytes one has more than the other, at least; an edit changes three characters' runs.

    Runs are counted in classes, which can only bring texts nearer.
    """
    return more_than(gram_counts(left), gram_counts(right))


def all_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The runs of three characters of a text, in order, and how often it has each."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    gram = np.sort(code[:-2] << np.uint64(42) | code[1:-1] << np.uint64(21) | code[2:])
    begin = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])[:len(gram)])
    return gram[begin], np.diff(begin, append=len(gram))


def in_common(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> int:
    """How many runs two texts have in common, each as often as both have it."""
    if not len(left[0]) or not len(right[0]):
        return 0
    at = np.minimum(np.searchsorted(left[0], right[0]), len(left[0]) - 1)
    return int(np.minimum(left[1][at], right[1])[left[0][at] == right[0]].sum())


def letter_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The length of each line, and how many of its characters fall into each of 28 classes."""
    size = np.array([len(x) for x in texts])
    code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32) % 28
    return size, np.bincount(np.repeat(np.arange(len(texts)), size) * 28 + code, minlength=28 * len(texts)).reshape(-1, 28).astype(np.int32)


def links_between(component: np.ndarray, texts: list[str], threshold: float) -> list[tuple[int, int]]:
    """Places (i, j) of near lines that connect all components which near lines connect; no more links than components.

    Lines of components that a link has joined are not compared again. An edit changes a line's length by one at most,
    takes and gives one letter at most, and changes three runs of three characters at most, which refuses most of the others.
    """
    size, letters = letter_counts(texts)
    column = pa.array(texts, pa.string())
    grams: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(texts)
    own, links, counts = component.copy(), [], None
    for i in range(len(texts)):
        after = np.arange(i + 1, len(texts))
        after = after[own[after] != own[i]]
        longer = np.maximum(size[after], size[i])
        most = ((1 - threshold) * longer + 1e-9).astype(np.int64)
        close = np.flatnonzero(more_than(letters[after], letters[i]) <= most)
        if len(close) and counts is None:
            counts = gram_counts(column)
        close = close[more_than(counts[after[close]], counts[i]) <= 3 * most[close]] if len(close) else close
        for j, k in zip(after[close].tolist(), most[close].tolist()):
            if own[j] == own[i]:
                continue
            for at in (i, j):
                if grams[at] is None:
                    grams[at] = all_grams(texts[at])
            if max(size[i], size[j]) - 2 - in_common(grams[i], grams[j]) <= 3 * k and distance_within(texts[i], texts[j], k, likely=False):
                links.append((i, j))
                own[own == own[j]] = own[i]
    return links


def open_links(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that join the components which near lines of a bucket connect. ``rows`` (key, blocks, node, component, line_text).

    Buckets of one block are read in a stream, one at a time; nodes of larger ones are dealt to pairs of blocks, each of
    which is such a bucket again, so a task holds two blocks at most.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [None, [], [], []]

        def finish() -> list[tuple[int, int]]:
            node, component, texts = held[1:]
            return [(max(node[i], node[j]), min(node[i], node[j])) for i, j in links_between(np.array(component), texts, threshold)] if len(node) > 1 else []

        def sent(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            found = []
            for group, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if group != held[0]:
                    found += finish()
                    held[:] = [group, [], [], []]
                for values, value in zip(held[1:], row):
                    values.append(value)
            yield sent(found)
        yield sent(finish())

    stream = dealt.select(group.alias("group"), "node", "component", "line_text").repartition("group").sortWithinPartitions("group", "node")
    return stream.mapInArrow(run, "a long, b long").distinct()


def shared_blocks(nodes: DataFrame) -> DataFrame:
    """(key, n, node, low): the ``n`` nodes of every block that several share, with the bucket's first. ``nodes`` has (node, keys).

    ``key`` stands for the nodes of a bucket: the same for blocks with the same nodes. Keys are dealt out many to a row, as
    there are over ten for each node and few are shared; a task sorts those of one part, of which there are as many as
    partitions in a shuffle.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(1).flatten().to_numpy()
            node = np.repeat(batch.column(0).to_numpy(), batch.column(1).value_lengths().to_numpy())
            part = (mix(key.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            size = np.bincount(part, minlength=parts)
            some = np.flatnonzero(size)
            ends = pa.array(np.concatenate([[0], np.cumsum(size[some])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (key, node))], ["part", "keys", "nodes"])

    def run(group: pa.Table) -> pa.Table:
        key, node = (group[c].combine_chunks().flatten().to_numpy() for c in ("keys", "nodes"))
        order = np.argsort(key)
        key, node = key[order], node[order]
        same = np.concatenate([[False], key[1:] == key[:-1], [False]])
        key, node = (x[same[1:] | same[:-1]] for x in (key, node))
        # A node may have a key twice.
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])[:len(key)]
        key, node = key[once], node[once]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        n = np.diff(begin, append=len(key))
        several = np.repeat(n > 1, n)
        low = np.repeat(node[begin], n)
        name = mix(np.add.reduceat(mix(node.view(np.uint64) + _ODD), begin) + n.astype(np.uint64)) if len(begin) else np.zeros(0, np.uint64)
        return pa.table({"key": np.repeat(name, n).view(np.int64)[several], "n": np.repeat(n, n)[several], "node": node[several], "low": low[several]})

    dealt = nodes.select("node", "keys").mapInArrow(deal, "part int, keys array<long>, nodes array<long>")
    return stored(dealt.groupBy("part").applyInArrow(run, "key long, n long, node long, low long"), "members")


def joined_components(groups: DataFrame, more: DataFrame) -> DataFrame:
    """(node, component) as ``components`` gives it for the links that have led to ``groups`` together with those of ``more`` (a, b)."""
    ends = more
    for end in ("a", "b"):
        named = groups.select(F.col("node").alias(end), F.col("component").alias("known"))
        ends = ends.join(named, end, "left").withColumn(end, F.coalesce("known", end)).drop("known")
    # Components are the nodes now; one that is no component yet is a line by itself.
    moved = stored(components(ends).withColumnRenamed("component", "low"), "moved")
    old = groups.join(moved.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("low", "component").alias("component"))
    return old.union(moved.join(groups, "node", "left_anti").select("node", "low"))


def _kept_places(known: DataFrame, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(id, places): the lines that stay of each text."""
    nodes = stored(line_rows(known, id_col, text_col).groupBy("h1", "h2").agg(F.min(F.struct("id", "line")).alias("first"), F.min("keys").alias("keys")), "nodes")
    members = shared_blocks(nodes.select(F.col("h1").alias("node"), "keys"))
    star = stored(members.where("node > low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct(), "pairs")
    text = line_texts(known, star, text_col)
    groups = stored(components(verified(text, star, threshold)), "groups")
    # Of two nodes the first has been compared with the other.
    rows = open_members(members.where("n > 2").select("key", "node").distinct(), groups, least=3)
    more = stored(open_links(rows.join(text, "node"), threshold), "links")
    groups = stored(joined_components(groups, more).withColumnRenamed("node", "h1"), "groups")
    # The same condition for both, so that they share a shuffle.
    nodes = nodes.where("h1 IS NOT NULL").select("h1", "first")
    linked = nodes.join(groups, "h1").groupBy("component").agg(F.min("first").alias("first"))
    kept = nodes.join(groups, "h1", "left_anti").select("first").union(linked.select("first"))
    return kept.groupBy("first.id").agg(F.collect_list("first.line").alias("places"))


def deduplicate_lines(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(id, n_lines, n_removed, kept): every row's text without the lines that occur before, here or in another text.

    The columns ``carry`` come along as they are, in a struct of this name.
    """
    with scratch(docs.sparkSession):
        places = stored(_kept_places(docs.where(F.col(id_col).isNotNull()), threshold, id_col, text_col), "places", keep=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = {i for i in range(128) if _NORMAL[i] in (10, 32)}
        blank = bytes(sorted(space))
        for batch in batches:
            lines, removed, out = [], [], []
            for text, own in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                if text is None:
                    lines.append(0), removed.append(0), out.append(None)
                    continue
                parts, own = text.split(b"\n"), None if own is None else set(own)
                left = parts if own is None else [x for i, x in enumerate(parts) if i in own or not x.strip(blank)]
                lines.append(len(parts)), removed.append(len(parts) - len(left)), out.append(b"\n".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lines, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.binary()).cast(pa.string()), *batch.columns[3:]],
                schema.names)

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_lines", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()), *carried(docs, carry)])
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *([F.struct(*carry).alias("carry")] if carry else []))
    met = source.join(places, "id", "left").select("id", "text", F.when(F.col("id").isNotNull(), F.coalesce("places", F.array().cast("array<int>"))).alias("places"), *(["carry"] if carry else []))
    return met.mapInArrow(run, schema).withColumnRenamed("id", id_col)
