"""Near-duplicate documents by ProbMinHash over weighted word shingles, banding, and exact verification.

Every distinct shingle of a text is a Poisson process whose rate is its weight; arrivals fall on random registers, which
keep the first. A process ends once its next arrival is later than every register's first, so most end after one or
two steps. Two texts agree in a register with their probability Jaccard similarity. Each text is sketched with weight 1
for every shingle, where that similarity is the Jaccard similarity of the shingle sets, and with the shingles' counts.
Registers are joined into bands; texts that share a band of either sketch are compared, and linked if their shingle
sets have a Jaccard similarity of at least ``threshold``. So a pair is retrieved by the measure that decides on it,
however often shingles repeat. Classes are the connected components of links.

Copies of a text are one node. In a bucket all nodes are first compared with its most central one, which settles the
usual groups in one comparison for each node. Only buckets that still hold several components go on: there every
pair of nodes from different components is compared by its registers, block by block, and verified. So no link that
could join two components is left out, while a group of copies costs its size and not its square.

Defined cases: texts without words, null texts and rows without id are alone in their class. A text of fewer words than a shingle is one
shingle. Ids are integers. An id that occurs with several texts joins their classes. Very long texts are sketched whole,
in slices of a few texts. Of a class the least id names it. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from inplay.llm.common import Words, mix, scratch, slices, stored
from inplay.llm.components import components

#: Nodes of a bucket that one task compares with as many others.
BLOCK = 1024
#: Shingles by which open pairs are judged before their texts are compared.
SMALLEST = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shingles of all rows with their row; a row with fewer words than ``width`` has one of all its words."""
    hashed = words.hashes()
    found, at = words.windows(hashed, width)
    row = np.searchsorted(words.first, at, side="right") - 1
    short = np.flatnonzero((np.diff(words.first) > 0) & (np.diff(words.first) < width))
    if len(short):
        own = [mix(np.array([sum(int(h) * pow(31, k, 1 << 64) for k, h in enumerate(hashed[a:b])) % (1 << 64)], np.uint64))[0]
               for a, b in zip(words.first[short].tolist(), words.first[short + 1].tolist())]
        found, row = np.concatenate([found, np.array(own, np.uint64)]), np.concatenate([row, short])
    return found, row


def weighted(found: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row, their rows, and how often they occur there."""
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (row[1:] != row[:-1])])[:len(found)])
    return found[first], row[first], np.diff(np.concatenate([first, [len(found)]]))


def sketch(found: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """For each row and register the element that arrives first there, as its hash (0 where the row has no element)."""
    time = np.full(rows * registers, np.inf)
    winner = np.zeros(rows * registers, np.uint64)
    at = np.zeros(len(found))
    element, owner, rate, state = found, row, weight.astype(float), mix(found + _STEP)
    while len(element):
        state = mix(state + _STEP)
        # 53 bits make the exponential gap, six others and more the register.
        gap = -np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate
        at = at + gap
        place = owner * registers + (mix(state ^ _STEP) % np.uint64(registers)).astype(np.int64)
        sooner = at < time[place]
        p, t, e = place[sooner], at[sooner], element[sooner]
        np.minimum.at(time, p, t)
        won = time[p] == t
        winner[p[won]] = e[won]
        latest = time.reshape(rows, registers).max(1)
        on = at < latest[owner]
        element, owner, rate, state, at = element[on], owner[on], rate[on], state[on], at[on]
    return winner.reshape(rows, registers)


def banded(won: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The registers of each sketch, ``rows`` at a time, as one hash a band."""
    keys = np.zeros((len(won), bands), np.uint64)
    for k in range(rows):
        keys = mix(keys * _STEP + won.reshape(-1, bands, rows)[:, :, k] + np.arange(bands, dtype=np.uint64))
    return keys


def sketches(docs: DataFrame, bands: int, rows: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, bands, registers) of every row; texts without words have null bands.

    ``bands`` are hashed values of ``rows`` registers each: of the sketch with weight 1 for every shingle, and of the sketch
    by counts where this is another. ``registers`` has one byte of each register of the first.
    """
    count = bands * rows
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("digest", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("registers", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                words = Words(part.column(1))
                found, row, weight = weighted(*shingles(words, width))
                won = sketch(found, row, np.ones(len(found)), part.num_rows, count)
                # Where no shingle repeats, the weighted sketch is the same.
                repeats = np.unique(row[weight > 1])
                own = np.isin(row, repeats)
                heavy = sketch(found[own], np.searchsorted(repeats, row[own]), weight[own], len(repeats), count)
                keys = banded(np.concatenate([won, heavy]), bands, rows)
                owner = np.concatenate([np.arange(part.num_rows), repeats])
                keys = keys[np.argsort(owner, kind="stable")]
                empty = np.diff(words.first) == 0
                data, ends = words.data.tobytes(), words.offsets.tolist()
                digest = [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(ends, ends[1:])]
                low = (won & np.uint64(255)).astype(np.uint8)
                offsets = pa.array((np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=part.num_rows))]) * bands).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64).ravel()), mask=pa.array(empty))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(digest, pa.binary()), lists, pa.array([x.tobytes() for x in low], pa.binary())],
                    ["id", "digest", "bands", "registers"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def jaccard(texts: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """(a, b, similarity): exact Jaccard similarity of the shingle sets of each pair. ``texts`` is (node, text)."""
    rows = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))

    def sets(column: pa.Array) -> list[np.ndarray]:
        found, row, _ = weighted(*shingles(Words(column), width))
        return np.split(found, np.searchsorted(row, np.arange(1, len(column))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in range(0, batch.num_rows, 256):
                part = batch.slice(step, 256)
                # Pairs of one node mostly lie side by side; its set is made once.
                b = part.column(2).dictionary_encode()
                left, right, own = sets(part.column(1)), sets(b.dictionary), b.indices.to_pylist()
                common = [len(np.intersect1d(x, right[i], assume_unique=True)) for x, i in zip(left, own)]
                value = [c / (len(x) + len(right[i]) - c) if c else 0.0 for c, x, i in zip(common, left, own)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), pa.array(value, pa.float64())], ["a", "b", "similarity"])

    return rows.select("a", "text_a", "text_b", "b").mapInArrow(run, "a long, b long, similarity double")


def central_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each node of a bucket with the bucket's most central node, which shares most buckets with others."""
    size = members.groupBy("key").agg(F.count("*").alias("n"))
    degree = members.join(size, "key").groupBy("node").agg(F.sum("n").alias("degree"))
    centre = members.join(degree, "node").groupBy("key").agg(F.max_by("node", F.struct("degree", -F.col("node"))).alias("b"))
    return members.join(centre, "key").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def open_members(members: DataFrame, groups: DataFrame, least: int = 2) -> DataFrame:
    """(key, blocks, node, component) of the buckets of ``least`` nodes that hold several components; buckets with the same nodes count once."""
    # A node without links is its own component.
    named = members.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    buckets = named.groupBy("key").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"),
        F.min("component").alias("low"), F.max("component").alias("high")).where((F.col("low") < F.col("high")) & (F.col("n") >= least))
    buckets = buckets.groupBy("n", "s", "x").agg(F.min("key").alias("key"))
    return named.join(buckets.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "key").select("key", "blocks", "node", "component")


def open_pairs(rows: DataFrame, features: DataFrame, near: Callable[[list[bytes], list[bytes]], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(a, b): nodes of a bucket in different components whose ``features`` (node, feature) are near; a > b.

    ``near`` gives the places of near pairs among two lists of features. Large buckets are compared in blocks of pairs.
    """
    rows = (rows.join(features, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "node", "component", "feature"))

    def run(key: tuple, group: pa.Table) -> pa.Table:
        p, q = key[1].as_py(), key[2].as_py()
        own, node, part = (group[c].to_numpy() for c in ("own", "node", "component"))
        feature = group["feature"].to_pylist()
        left, right = np.flatnonzero(own == p), np.flatnonzero(own == q)
        names, counts = np.unique(part, return_counts=True)
        main = names[counts.argmax()]
        a, b = [], []
        # Pairs inside the largest component are settled.
        for x, y in ((left, right), (right, left)) if p != q else ((left, right),):
            x = x[part[x] != main]
            for at in range(0, len(x), 64):
                some = x[at:at + 64]
                i, j = near([feature[k] for k in some], [feature[k] for k in y])
                i, j = node[some][i][(keep := part[some][i] != part[y][j])], node[y][j][keep]
                a.append(np.maximum(i, j))
                b.append(np.minimum(i, j))
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        found = np.unique(np.stack([a, b]), axis=1)
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return rows.groupBy("key", "p", "q").applyInArrow(run, "a long, b long").distinct()


def smallest(texts: DataFrame, width: int) -> DataFrame:
    """(node, smallest): the least ``SMALLEST`` of each text's distinct shingles, 32 bits each; all of them where there are fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                found, row, _ = weighted(*shingles(Words(part.column(1)), width))
                own = np.split((found >> np.uint64(32)).astype(np.uint32), np.searchsorted(row, np.arange(1, part.num_rows)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x[:SMALLEST].tobytes() for x in own], pa.binary())], ["node", "smallest"])

    # An id with several texts counts by one of them here; each is compared when the pair is verified.
    return texts.mapInArrow(run, "node long, smallest binary").groupBy("node").agg(F.min("smallest").alias("smallest"))


def near_by_samples(registers: int, threshold: float) -> Callable:
    """Whether pairs can be at the threshold: by their registers, then by their smallest shingles.

    An estimate from n samples strays by five standard deviations once in three million pairs at the threshold; of texts with fewer
    than ``SMALLEST`` shingles the second is the similarity itself.
    """
    first, second = (threshold - 5 * (threshold * (1 - threshold) / n) ** 0.5 for n in (registers, SMALLEST))

    def near(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        x, y = (np.frombuffer(b"".join(f[:registers] for f in side), np.uint8).reshape(-1, registers) for side in (left, right))
        i, j = np.nonzero((x[:, None] == y[None]).mean(2) >= min(first, threshold - 0.3))
        x, y = ([np.frombuffer(f, np.uint32, offset=registers) for f in side] for side in (left, right))
        keep = np.zeros(len(i), bool)
        for k, (m, n) in enumerate(zip(i.tolist(), j.tolist())):
            every = np.sort(np.concatenate([x[m], y[n]]))
            twice = np.flatnonzero(every[1:] == every[:-1])
            whole = max(len(x[m]), len(y[n])) < SMALLEST
            # Of the union's smallest values, how many do both have?
            size = len(every) - len(twice)
            if not whole and size > SMALLEST:
                distinct = np.delete(every, twice)
                size, twice = SMALLEST, twice[every[twice] <= distinct[SMALLEST - 1]]
            keep[k] = len(twice) >= (threshold - 0.01 if whole else second) * size
        return i[keep], j[keep]

    return near


def near_duplicates(docs: DataFrame, threshold: float = 0.8, width: int = 5, bands: int = 24, rows: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id): the least id of each document's class.

    A pair at the threshold, of whatever counts, shares no band with a probability of (1 - threshold ** rows) ** bands, 3e-6 here.
    Every row of ``docs`` has one row; rows without words have their own id as class, rows without id null.
    """
    with scratch(docs.sparkSession):
        groups = stored(_classes(docs, threshold, width, bands, rows, id_col, text_col), "groups", keep=True)
    known = groups.select(F.col("node").alias("_id"), F.col("component").alias("class_id"))
    ids = docs.select(F.col(id_col), F.col(id_col).cast("long").alias("_id"))
    return ids.join(known, "_id", "left").select(id_col, F.coalesce("class_id", "_id").alias("class_id"))


def _classes(docs: DataFrame, threshold: float, width: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(node, component) of the ids that are linked to others."""
    found = stored(sketches(docs.where(F.col(id_col).isNotNull()), bands, rows, width, id_col, text_col), "sketches")
    worded = found.where("bands IS NOT NULL")
    nodes = stored(worded.groupBy("digest").agg(F.min("id").cast("long").alias("node"), F.first("bands").alias("bands"), F.first("registers").alias("registers")), "nodes")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = stored(keyed.join(shared, "key").select("key", "node").distinct(), "members")
    first = stored(central_pairs(members), "pairs")

    def texts(ends: DataFrame) -> DataFrame:
        own = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
        # An id with several texts is compared by each of them. The plan is the same at every size.
        return stored(own.join(ends.distinct().hint("merge"), "node", "left_semi"), "texts")

    own = texts(first.select(F.col("a").alias("node")).union(first.select("b")))
    links = stored(jaccard(own, first, width).where(F.col("similarity") >= threshold), "links")
    rows_open = stored(open_members(members, components(links.select("a", "b"))), "open")
    if not rows_open.isEmpty():
        own = texts(rows_open.select("node"))
        features = smallest(own, width).join(nodes.select("node", "registers"), "node").select("node", F.concat("registers", "smallest").alias("feature"))
        more = stored(open_pairs(rows_open, stored(features, "features"), near_by_samples(bands * rows, threshold)), "pairs")
        links = links.unionByName(stored(jaccard(own, more, width).where(F.col("similarity") >= threshold), "links"))
    copies = worded.join(nodes.select("digest", "node"), "digest").select(F.col("id").cast("long").alias("id"), "node")
    return components(links.select("a", "b").union(copies.select(F.col("id").alias("a"), F.col("node").alias("b"))))
