"""The trie of conversation prefixes, with what its subtrees hold, by the Euler-tour technique.

A node is a distinct sequence of first turns (role, text); conversations that begin with it are its members. Turns
are put in order by a range exchange and read in order by tasks, each of which carries on what the task before has left
off: so positions and prefix hashes (two polynomials modulo 2**61 - 1 over 128-bit digests of the turns) need no
conversation to be in one task. Nodes are numbered by their smallest member and depth, so most that follow each other in
the tour have close numbers. Every node has an arc that enters it and one that leaves it; each arc's successor comes
from a node's first child, next sibling and parent. The tour is ranked as a list (``listrank``); what a subtree holds is
the difference of the sums before its two arcs.

Defined cases: rows without a conversation take no part. A null role or text is empty. Turns come in the order of turn
(null first), role, text; repeated rows are turns of their own. A conversation may have no turns. Long texts count by
their bytes and are hashed whole. An empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from inplay.llm.common import scratch, slices, sql_crc32, stored
from inplay.llm.listrank import ranked

_P = (1 << 61) - 1
#: Bases of the two polynomials.
_BASES = (1_000_003 ** 3 % _P, 998_244_353 ** 2 % _P)
#: Bits of a node's number within a cell; nodes of a cell are dealt together.
_CELL_BITS = 13


def _spans(rows: DataFrame, *sums: str) -> DataFrame:
    """``rows`` (part, conv_id, step, sums), in order by part and step, with ``ahead_<sum>`` modulo 2**61 - 1: what the
    parts before hold of the conversation.

    A conversation lies in several parts only if it ends one and begins a later one: as many as parts at most, and so many rows are broadcast.
    """
    edges = rows.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    torn = edges.select(F.col("low").alias("conv_id"), "part").union(edges.select("high", "part")).distinct().groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id")
    ends = rows.join(F.broadcast(torn), "conv_id").groupBy("conv_id", "part").agg(F.max(F.struct(F.col("step").alias("at"), *sums)).alias("s"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ends.select("conv_id", "part", *((F.coalesce(F.sum(F.col(f"s.{c}").cast("decimal(38,0)")).over(before), F.lit(0)) % _P).cast("long").alias(f"ahead_{c}") for c in sums))
    return rows.join(F.broadcast(ahead), ["conv_id", "part"], "left").fillna(0, [f"ahead_{c}" for c in sums])


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, place, h1, h2, size): the turns with their place from 0, a digest of role and text, and the text's bytes."""
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # The row's number only keeps equal rows apart, which are interchangeable; nulls come first.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "text", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            for some in slices(batch, "text"):
                conv = some.column(0).to_numpy()
                begin = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
                step = np.arange(len(conv)) - np.repeat(begin, np.diff(begin, append=len(conv)))
                if conv[0] == last:
                    step[:begin[1] if len(begin) > 1 else None] += count
                last, count = conv[-1], int(step[-1]) + 1
                digest, size = [], []
                for role, text in zip(some.column(1).to_pylist(), some.column(2).cast(pa.binary()).to_pylist()):
                    size.append(len(text))
                    digest.append(xxhash.xxh3_128_intdigest(f"{len(role)}:{role}:".encode() + text))
                yield pa.RecordBatch.from_arrays(
                    [some.column(3), some.column(0), pa.array(step + 1), *(pa.array([(d >> s & (1 << 64) - 1) % _P for d in digest], pa.int64()) for s in (0, 64)), pa.array(size, pa.int64())],
                    ["part", "conv_id", "step", "h1", "h2", "size"])

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text", F.spark_partition_id().alias("part"))
    read = stored(dealt.mapInArrow(run, "part int, conv_id long, step long, h1 long, h2 long, size long"), "turns")
    return _spans(read, "step").select("conv_id", (F.col("step") + F.col("ahead_step") - 1).alias("place"), "h1", "h2", "size")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a1, a2, b1, b2, size): a hash of the first turns of each depth, and of those but the last. ``turns`` as above."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place_next, power, total = None, -1, [0, 0], [0, 0]
        for batch in batches:
            out: list[list[int]] = [[], [], [], []]
            for conv, place, *h in zip(*(c.to_pylist() for c in batch.columns[1:])):
                if conv != last:
                    total = [0, 0]
                if conv != last or place != place_next:
                    power = [pow(b, place, _P) for b in _BASES]
                for k in (0, 1):
                    out[2 + k].append(total[k])
                    total[k] = (total[k] + (h[k] + 1) * power[k]) % _P
                    out[k].append(total[k])
                    power[k] = power[k] * _BASES[k] % _P
                last, place_next = conv, place + 1
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.asarray(batch.column(2)) + 1), *(pa.array(x, pa.int64()) for x in out), batch.column(5)],
                    ["part", "conv_id", "step", "a1", "a2", "b1", "b2", "size"])

    dealt = turns.repartitionByRange("conv_id", "place").sortWithinPartitions("conv_id", "place")
    dealt = dealt.select(F.spark_partition_id().alias("part"), "conv_id", "place", "h1", "h2", "size")
    read = stored(dealt.mapInArrow(run, "part int, conv_id long, step long, a1 long, a2 long, b1 long, b2 long, size long"), "prefixes")
    whole = _spans(read, "a1", "a2")
    return whole.select("conv_id", F.col("step").alias("depth"), *(((F.col(f"{x}{k}") + F.col(f"ahead_a{k}")) % _P).alias(f"{x}{k}") for x in "ab" for k in (1, 2)), "size")


def rebuilt(turns: DataFrame, convs: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """``turns`` in which every conversation c of ``convs`` begins with the first h turns of c - c % group; its own first h go.

    h is the CRC-32 of the decimal c modulo ``most``.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    known = convs.select("conv_id").distinct().select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    heads = turns.where(F.col("place") < most - 1).select(F.col("conv_id").alias("base"), "place", "h1", "h2", "size")
    begun = known.join(heads, "base").where("place < h")
    given = begun.groupBy("conv_id").agg(F.count("*").alias("given"))
    own = turns.where(F.col("place") >= h).join(given, "conv_id", "left")
    own = own.select("conv_id", (F.col("place") - h + F.coalesce("given", F.lit(0))).alias("place"), "h1", "h2", "size")
    return begun.select("conv_id", "place", "h1", "h2", "size").unionByName(own)


def _joined_ids(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of ``ends`` (node, conv_id): the hash of a node's ids, ascending, joined by commas.

    Tasks join what they have of a node; a hash takes its bytes in one row, so one task then reads the node's pieces, one at a time.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, conv = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            begin = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])[:len(node)])
            text = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(node)])]
            yield pa.RecordBatch.from_arrays([pa.array(node[begin]), pa.array(conv[begin]), pa.array(text, pa.string())], ["node", "first", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != last:
                    if sha is not None:
                        done.append((last, sha.hexdigest()))
                    last, sha = node, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.int64()), pa.array([x for _, x in done], pa.string())], ["node", "ends_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([sha.hexdigest()])], ["node", "ends_sha256"])

    joined = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(pieces, "node long, first long, ids string")
    return joined.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(hashes, "node long, ends_sha256 string")


def _next_sibling(nodes: DataFrame) -> DataFrame:
    """(node, next): a node's next sibling by number, null for the last. Siblings are linked in cells of numbers, and the cells then."""
    rows = nodes.where("up IS NOT NULL").select("up", "node", F.shiftright("node", _CELL_BITS).alias("cell"))
    cells = rows.groupBy("up", "cell").agg(F.min("node").alias("first")).select("up", "cell", F.lead("first").over(Window.partitionBy("up").orderBy("cell")).alias("first_after"))
    linked = rows.withColumn("next", F.lead("node").over(Window.partitionBy("up", "cell").orderBy("node"))).join(cells, ["up", "cell"])
    return linked.select("node", F.coalesce("next", "first_after").alias("next"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the conversations ``convs`` (conv_id) with the ``turns`` (conv_id, place, h1, h2, size).

    conv_id: smallest member; depth; parent_conv_id: the parent's conv_id; n_convs: members; n_children; n_leaves: childless
    nodes of the subtree; saved_tokens: of the subtree, (members - 1) times the bytes of a node's last text; ends_sha256:
    hash of the ids of the members that end here.
    """
    with scratch(turns.sparkSession):
        return stored(_nodes(turns, convs.select("conv_id").distinct()), "trie", keep=True)


def _nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    found = prefixes(turns)
    found = stored(found.unionByName(convs.select("conv_id", F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(c) for c in ("a1", "a2", "b1", "b2", "size")))), "members")
    nodes = found.groupBy("depth", "a1", "a2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *(F.min(c).alias(c) for c in ("b1", "b2", "size")))
    # Numbers are the places in this order: the nodes of which one conversation is the smallest member follow each other.
    order = ["conv_id", "depth"]
    nodes = stored(nodes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("node", F.monotonically_increasing_id()), "nodes")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a1").alias("b1"), F.col("a2").alias("b2"), F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(up, ["depth", "b1", "b2"], "left")
    kids = nodes.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.min("node").alias("child"), F.count("*").alias("n_children"))
    nodes = stored(nodes.join(kids, "node", "left").join(_next_sibling(nodes), "node", "left").select(
        "node", "up", "child", "next", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"), "a1", "a2"), "nodes")
    enter, leave = (lambda c: F.col(c) * 2), (lambda c: F.col(c) * 2 + 1)

    def arc(id_: Column, after: Column, leaf: Column, saved: Column) -> Column:
        return F.struct(id_.alias("id"), after.alias("next"), leaf.cast("long").alias("leaves"), saved.alias("saved"))

    both = F.explode(F.array(arc(enter("node"), F.coalesce(enter("child"), leave("node")), F.col("child").isNull(), F.col("saved")),
                             arc(leave("node"), F.coalesce(enter("next"), leave("up")), F.lit(False), F.lit(0).cast("long"))))
    arcs = nodes.repartition(F.shiftright("node", _CELL_BITS)).sortWithinPartitions("node").select(both.alias("arc")).select("arc.*")
    at = ranked(arcs, ["leaves", "saved"])
    held = at.groupBy(F.shiftright("id", 1).alias("node")).agg(*((F.max(c) - F.min(c)).alias(name) for c, name in (("leaves", "n_leaves"), ("saved", "saved_tokens"))))
    last = found.groupBy("conv_id").agg(F.max(F.struct("depth", "a1", "a2")).alias("end")).select("conv_id", "end.*")
    ends = _joined_ids(last.join(nodes.select("node", "depth", "a1", "a2"), ["depth", "a1", "a2"]).select("node", "conv_id"))
    nothing = hashlib.sha256().hexdigest()
    return nodes.join(held, "node").join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def oracle() -> str:
    """SQL for the trie of the rebuilt ``conversations``: prefixes as texts, and each node's descendants through its members."""
    crc = sql_crc32("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")
    return f"""
    WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
    known AS (SELECT conv_id, conv_id - conv_id % 5 AS base,
      {crc} % 9 AS h FROM ids),
    turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
      coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    rebuilt AS (SELECT k.conv_id, 0 AS part, t.place, t.role, t.text FROM known k JOIN turns t ON t.conv_id = k.base AND t.place < k.h
      UNION ALL SELECT k.conv_id, 1, t.place, t.role, t.text FROM known k JOIN turns t ON t.conv_id = k.conv_id AND t.place >= k.h),
    steps AS (SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS size,
      string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS prefix FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)),
    members AS (SELECT conv_id, depth, size, sha256(prefix) AS node, coalesce(lag(sha256(prefix)) OVER (PARTITION BY conv_id ORDER BY depth), '') AS parent FROM steps
      UNION ALL SELECT conv_id, 0, 0, '', NULL FROM ids),
    nodes AS (SELECT depth, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(size) AS saved FROM members GROUP BY depth, node),
    children AS (SELECT parent, depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
    grown AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.parent = n.node AND c.depth = n.depth + 1),
    held AS (SELECT m.depth, m.node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM grown g JOIN members m ON m.conv_id = g.conv_id AND m.depth <= g.depth GROUP BY ALL),
    ends AS (SELECT depth, node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
      FROM (SELECT * FROM members QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY ALL)
    SELECT g.conv_id, g.depth, p.conv_id AS parent_conv_id, g.n_convs, g.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
    FROM grown g JOIN held h ON h.depth = g.depth AND h.node = g.node LEFT JOIN nodes p ON p.depth = g.depth - 1 AND p.node = g.parent LEFT JOIN ends e ON e.depth = g.depth AND e.node = g.node"""
