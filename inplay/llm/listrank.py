"""List ranking: sums of weights over everything that comes before an element of a linked list.

The list is made shorter until ``BASE`` elements are left, which one task ranks. First every run of elements that lie
in one Arrow batch and follow each other becomes one; elements whose ids are close should follow each other. Then, in
rounds, each element whose coin shows tails and whose predecessor's shows heads is taken into its predecessor, a
quarter of all: the coin is a hash of id and round, so both ends know it, and an element sends a message to either
neighbour. On the way back every element taken in gets its predecessor's sums and what had been in front of it there.
All work is joins and groupings by element; no list, however long, is in one task, and each round is a table in the
shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from inplay.llm.common import stored

#: Elements that one task ranks in the end.
BASE = 4096


def shortened(arcs: DataFrame, weights: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Runs of ``arcs`` (id, next, weights) in a batch as one element each, and (id, head, weights): an element's run and what is before it there.

    ``arcs`` are dealt so that elements with close ids lie together.
    """
    names = ["id", "next", *weights]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("id", "head", "next", *weights, *(f"all_{w}" for w in weights))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_, next_ = batch.column(0).to_numpy(), batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            if not len(id_):
                continue
            order = np.argsort(id_)
            id_, next_ = id_[order], next_[order]
            own = [batch.column(2 + k).to_numpy()[order] for k in range(len(weights))]
            at = np.minimum(np.searchsorted(id_, next_), len(id_) - 1)
            inside = id_[at] == next_
            before = np.full(len(id_), -1)
            before[at[inside]] = np.flatnonzero(inside)
            # Doubling: what lies between an element and the one it points to, until all point to their run's head.
            ahead = np.where(before >= 0, before, np.arange(len(id_)))
            sums = [np.where(before >= 0, w[ahead], 0) for w in own]
            while (ahead[ahead] != ahead).any():
                sums = [s + s[ahead] for s in sums]
                ahead = ahead[ahead]
            last = np.flatnonzero(~inside)
            after, total = np.full(len(id_), -1), [np.zeros(len(id_), np.int64) for _ in own]
            after[ahead[last]] = next_[last]
            for t, s, w in zip(total, sums, own):
                t[ahead[last]] = s[last] + w[last]
            yield pa.RecordBatch.from_arrays(
                [pa.array(id_), pa.array(id_[ahead]), pa.array(after, mask=after < 0), *map(pa.array, sums), *map(pa.array, total)], schema.names)

    rows = stored(arcs.select(*names).mapInArrow(run, schema), "runs")
    heads = rows.where("id = head").select("id", "next", *(F.col(f"all_{w}").alias(w) for w in weights))
    return heads, rows.select("id", "head", *weights)


def _heads(element: Column, round_: int) -> Column:
    return F.xxhash64(element, F.lit(round_)) % 2 == 0


def _round(rows: DataFrame, weights: Sequence[str], number: int) -> DataFrame:
    """``rows`` (id, prev, next, weights) after a round, with what each has taken in: (taken, had_<weight>)."""
    # The first element has no predecessor; a hash of null is a value.
    gone = F.col("prev").isNotNull() & ~_heads(F.col("id"), number) & _heads(F.col("prev"), number)
    none = F.lit(None).cast("long")

    def message(to: str, **given: str) -> Column:
        columns = ["prev", "next", "own", "taken", *weights]
        return F.struct(F.col(to).alias("id"), *(F.col(given[c]).alias(c) if c in given else none.alias(c) for c in columns))

    all_own = {w: w for w in weights}
    sent = F.when(gone, F.array(message("prev", next="next", taken="id", **all_own), message("next", prev="prev"))).otherwise(F.array(message("id", prev="prev", next="next", own="id", **all_own)))
    # An element's own row and its messages: a message's value wins, and a message that it takes in ends at the list's end too.
    mail = rows.select(F.explode(sent).alias("m")).select("m.*").where("id IS NOT NULL")
    is_own = F.col("own").isNotNull()
    own = lambda c: F.max(F.when(is_own, F.col(c)))
    told = lambda c: F.max(F.when(~is_own, F.col(c)))
    return mail.groupBy("id").agg(
        F.coalesce(told("prev"), own("prev")).alias("prev"),
        F.when(told("taken").isNotNull(), told("next")).otherwise(own("next")).alias("next"),
        *(F.sum(w).alias(w) for w in weights), told("taken").alias("taken"), *(own(w).alias(f"had_{w}") for w in weights))


def ranked(arcs: DataFrame, weights: Sequence[str]) -> DataFrame:
    """(id, weights): for each of ``arcs`` (id, next, weights) the sums over all that come before it in the list; next is null at its end."""
    heads, inside = shortened(arcs, weights)
    following = heads.where("next IS NOT NULL").select(F.col("next").alias("id"), F.col("id").alias("prev"))
    # Of the elements' own names, the one that a run ends before is always a head.
    rows, rounds = stored(heads.join(following, "id", "left").select("id", "prev", "next", *weights), "list"), []
    while rows.count() > BASE:
        rounds.append(stored(_round(rows, weights, len(rounds)), "list"))
        rows = rounds[-1].select("id", "prev", "next", *weights)
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("id", *weights)])

    def run(table: pa.Table) -> pa.Table:
        id_ = table["id"].to_numpy()
        next_ = dict(zip(id_.tolist(), table["next"].to_pylist()))
        place = {x: k for k, x in enumerate(id_.tolist())}
        at = next(x for x, p in zip(id_.tolist(), table["prev"].to_pylist()) if p is None)
        order = []
        while at is not None:
            order.append(place[at])
            at = next_[at]
        own = [table[w].to_numpy()[order] for w in weights]
        return pa.table([pa.array(id_[order]), *(pa.array(np.cumsum(w) - w) for w in own)], names=schema.names)

    sums = rows.groupBy(F.lit(0).alias("_all")).applyInArrow(run, schema)
    for taken in reversed(rounds):
        # Those that a round took in: their element's sums, and what that element had itself.
        more = taken.where("taken IS NOT NULL").select("id", "taken", *(f"had_{w}" for w in weights)).join(sums, "id")
        sums = stored(sums.unionByName(more.select(F.col("taken").alias("id"), *((F.col(w) + F.col(f"had_{w}")).alias(w) for w in weights))), "sums")
    sums = sums.select(F.col("id").alias("head"), *(F.col(w).alias(f"head_{w}") for w in weights))
    return inside.join(sums, "head").select("id", *((F.col(w) + F.col(f"head_{w}")).alias(w) for w in weights))
