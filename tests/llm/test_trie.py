import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from inplay.llm import listrank, queries, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Rows of the result from (conv_id, turn, role, text), by plain dictionaries of prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        turns = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for s in members:
        if s:
            children[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in children[s]) or 1
        saved[s] = sum(saved[k] for k in children[s]) + ((len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0)
    return {(members[s][0], len(s), members[s[:-1]][0] if s else None, len(members[s]), len(children[s]), leaves[s], saved[s],
             hashlib.sha256(",".join(map(str, ends[s])).encode()).hexdigest()) for s in members}


def trie_of(df):
    convs = df.where("conv_id IS NOT NULL").select("conv_id")
    return trie.prefix_trie(trie.rebuilt(trie.ordered_turns(df), convs), convs)


def columns(df):
    found = df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def test_op13(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert columns(queries.op13_prefix_trie(spark, sf)) == brute(rows)


@pytest.mark.parametrize("base, parts", [(4096, 4), (8, 4), (3, 13)])
def test_trie(spark, monkeypatch, base, parts):
    """Shared beginnings, a hot first turn, exact copies, one very long conversation over many parts, nulls, ties, repeated rows."""
    monkeypatch.setattr(listrank, "BASE", base)
    monkeypatch.setattr(trie, "_CELL_BITS", 3)
    rng = random.Random(base)
    rows = []
    for c in [*range(40), 103, 211, 10 ** 12 + 4]:
        n = 0 if c % 11 == 3 else rng.randrange(1, 14)
        for k in range(n):
            hot = c % 3 == 0 and (k == 0 or c % 2 == 0)
            rows.append((c, rng.choice([None, k]) if c % 7 == 1 else k, "user" if hot else rng.choice(["user", None]), "the same" if hot else rng.choice(["a", "bé", "", None])))
    rows += [(c, k, "user", "copied") for c in range(60, 90) for k in range(10)]
    rows += [(300, k, "user", f"t{k % 3}") for k in range(400)] + [(301, k, "user", f"t{k % 3}") for k in range(399)]
    rows += [(302, 1, "user", "again")] * 50 + [(None, 1, "user", "no conversation")] * 3
    rng.shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 AS node", "'x' AS depth", "2 AS part")
        assert columns(trie_of(df)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_trie_empty(spark):
    assert trie_of(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie_of(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    # The base gives no turn that the conversation would not lose as well.
    assert columns(trie_of(spark.createDataFrame([(3, None, None, None)], SCHEMA))) == brute([(3, None, None, None)])


@pytest.mark.parametrize("base", [2, 5, 1000])
def test_list_ranking(spark, monkeypatch, base):
    monkeypatch.setattr(listrank, "BASE", base)
    rng = random.Random(9)
    order = rng.sample(range(10 ** 6), 500)
    weight = {x: rng.randrange(5) for x in order}
    arcs = [(x, y, 1, weight[x]) for x, y in zip(order, [*order[1:], None])]
    rng.shuffle(arcs)
    got = listrank.ranked(spark.createDataFrame(arcs, "id long, next long, one long, w long").repartition(7), ["one", "w"]).collect()
    before, want = 0, {}
    for k, x in enumerate(order):
        want[x] = (k, before)
        before += weight[x]
    assert {r.id: (r.one, r.w) for r in got} == want and len(got) == 500
