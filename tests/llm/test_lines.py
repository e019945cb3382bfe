import hashlib
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from near import classes  # noqa: E402

from inplay.llm import lines, minhash, queries  # noqa: E402
from inplay.llm.common import Words  # noqa: E402


def normal(line):
    """Words of a normalised line, from its definition."""
    return re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", re.sub(r"[0-9]", "0", re.sub(r"[A-Z]", lambda m: m[0].lower(), line))).split(" ")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def folded(line):
    """A line as a node: small letters, white space folded."""
    return " ".join(w for w in re.sub(r"[\x00-\x20\x7f]+", " ", re.sub(r"[A-Z]", lambda m: m[0].lower(), line)).split(" ") if w)


def near(a, b, threshold=0.8):
    return 1 - distance(a, b) / max(len(a), len(b)) >= threshold - 1e-9


def keys_of(names):
    words = Words(lines.split_lines(pa.array(names, pa.string()), lines._NORMAL)[0])
    out = [set() for _ in names]
    for key, owner in zip(*(x.tolist() for x in lines.block_keys(words))):
        out[owner].add(key)
    return out


def brute(rows, threshold=0.8, by_keys=False):
    """rows of (id, text): lines kept, by plain comparison of all pairs, or of all that share a block."""
    first = {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            if any(normal(line)):
                first.setdefault(folded(line), (i, k))
    names = sorted(first, key=first.get)
    keys = keys_of(names) if by_keys else None
    links = [(x, y) for x, a in enumerate(names) for y, b in enumerate(names[:x])
             if (keys is None or keys[x] & keys[y]) and min(len(a), len(b)) >= threshold * max(len(a), len(b)) - 1e-9 and near(a, b, threshold)]
    group = classes(range(len(names)), links)
    stay = {first[names[n]] for n in group if group[n] == n}
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, 0, 0, None))
            continue
        parts = text.split("\n")
        kept = parts if i is None else [p for k, p in enumerate(parts) if (i, k) in stay or not any(normal(p))]
        out.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out, len(links)


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_op5(spark, sf, docs):
    """All that share a block, over the whole table; what the blocks miss is measured below."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {i: (n, gone, None if t is None else len(t), None if t is None else hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in brute(rows, by_keys=True)[0]}
    assert {r.doc_id: (r.n_lines, r.n_removed, r.n_kept_chars, r.kept_sha256) for r in queries.op5_fuzzy_lines(spark, sf).collect()} == want


def changed(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.6:
            words[at] = rng.choice(vocabulary)
        elif kind < 0.8:
            words.insert(at, rng.choice(vocabulary))
        elif len(words) > 2:
            del words[at]
    return words


def test_recall_by_length(docs):
    """Share of near pairs, judged by their edit similarity alone, that share a block: one word in 30, 20 or 12 changed, or one character."""
    rng = random.Random(4)
    base = sorted({folded(x) for r in docs.collect() for x in (r.text or "").split("\n") if len(x.split()) > 2 and len(x) < 600})
    vocabulary = [w for x in base for w in x.split()]
    # Short lines are few here, so some are cut from longer ones.
    base += [" ".join(x.split()[:k]) for k in (3, 5, 8, 11) for x in base[::3]]
    pairs = []
    for line in rng.sample(base, 1500):
        words = line.split()
        other = " ".join(changed(rng, words, max(1, round(len(words) * rng.choice([1 / 30, 1 / 20, 1 / 12]))), vocabulary))
        at = rng.randrange(len(line))
        pairs += [p for p in ((line, other), (line, line[:at] + rng.choice("qxé") + line[at + 1:])) if p[0] != p[1] and lines.distance_within(*p, int(0.2 * max(map(len, p))))]
    keys = keys_of([x for p in pairs for x in p])
    found, total = Counter(), Counter()
    for k, (a, _) in enumerate(pairs):
        length = next(n for n in (400, 150, 60, 20, 0) if len(a) >= n)
        total[length] += 1
        found[length] += bool(keys[2 * k] & keys[2 * k + 1])
    recall = {n: found[n] / total[n] for n in total}
    assert set(recall) == {0, 20, 60, 150, 400} and min(total.values()) > 30
    assert all(r >= 0.9 for r in recall.values()), recall


@pytest.mark.parametrize("block", [1024, 3])
def test_fuzzy_lines(spark, monkeypatch, block):
    """Equal to the comparison of all pairs, blocks or not: a hot group of variants, lines that only normalise alike, code, numbers."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(11)
    base = [f"word{i}" for i in range(90)]
    out = []
    for i in range(36):
        words = list(base)
        for at in rng.sample(range(90), i % 3):
            words[at] = words[at] + rng.choice("abc")
        out.append((i, "Seen  42 times.\n\n" + " ".join(words) + f"\nown line {rng.random()} number {'x' * (i % 7)}\n!!!"))
    out += [(100, "SEEN 42\ttimes."), (101, ""), (102, None), (None, "seen 42 times"), (103, "\n\n"),
            (104, "12 34 56\n98 70 11\n2019 2020\n1066 1492\nx = a + b\ny = c - d\nif (n) { return 1; }")]
    want, links = brute(out)
    assert links > 20
    got = lines.deduplicate_lines(spark.createDataFrame(out, "doc_id long, text string")).collect()
    assert ordered(got) == ordered(want)
    assert {r.kept for r in got if r.doc_id == 104} == {out[-1][1]}


def test_majority_counts_distinct_features():
    rng = random.Random(5)
    runs = [[rng.getrandbits(32) for _ in range(n)] for n in (1, 3, 254, 255, 256, 1500)]
    flat = [(g, f) for g, run in enumerate(runs) for f in run + run[:len(run) // 3]]
    rng.shuffle(flat)
    group, size, value = lines.majority(*(np.array(x, np.uint64) for x in zip(*flat)))
    assert group.tolist() == list(range(6)) and size.tolist() == [len(set(r)) for r in runs]
    for run, got in zip(runs, value.tolist()):
        bits = [2 * sum(f >> b & 1 for f in set(run)) > len(set(run)) for b in range(32)]
        assert got == sum(1 << b for b in range(32) if bits[b])


def test_filters_let_near_pairs_pass(spark):
    rng = random.Random(6)
    text = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 30))) for _ in range(50)]
    text += [t[:k] + t[k + 1:] for t in text for k in (0, len(t) // 2)]
    text = [t for t in text if t]
    want = {(i, j) for i, a in enumerate(text) for j, b in enumerate(text) if j < i and near(a, b)}
    pairs = [(i, j) for i in range(len(text)) for j in range(i)]
    apart = lines.grams_apart(pa.array([text[i] for i, _ in pairs]), pa.array([text[j] for _, j in pairs]))
    longer = np.array([max(len(text[i]), len(text[j])) for i, j in pairs])
    passed = {p for p, ok in zip(pairs, apart <= 3 * (0.2 * longer + 1e-9).astype(int)) if ok}
    assert want <= passed and len(passed) < len(pairs) / 2
    # Buckets in blocks or whole, every node a component of its own; one batch after the other. No more links than nodes.
    whole = classes(range(len(text)), want)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for blocks in (1, 3):
            rows = spark.createDataFrame([(5, blocks, i, i, t) for i, t in enumerate(text)], "key long, blocks int, node long, component long, line_text string")
            got = {tuple(r) for r in lines.open_links(rows, 0.8).collect()}
            assert got <= want and classes(range(len(text)), got) == whole and len(got) < len(text) * blocks
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lines_odd(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = lines.deduplicate_lines(odd).collect()
    assert ordered(got) == ordered(brute(rows)[0])
    assert lines.deduplicate_lines(odd.limit(0)).count() == 0
    # Very long lines: of many words, of few words over and over, of one word.
    letters = [a + b + c for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"]
    many = " ".join(letters[k * k % 599] + letters[k * 7 % 600] for k in range(30_000))
    few = " ".join(f"word{k % 97}" for k in range(5000))
    df = spark.createDataFrame([(1, many), (2, many.replace("akuaku", "other")), (3, "x" * 300_000), (4, few), (5, few.replace("word77 ", "sword77 "))], "doc_id long, text string")
    assert [r.n_removed for r in lines.deduplicate_lines(df).orderBy("doc_id").collect()] == [0, 1, 0, 0, 1]


def test_distance():
    rng = random.Random(4)
    for _ in range(3000):
        a = "".join(rng.choice("abü") for _ in range(rng.randrange(12)))
        b = "".join(rng.choice("abü") for _ in range(rng.randrange(12)))
        for most in range(6):
            assert lines.distance_within(a, b, most) == (distance(a, b) <= most), (a, b, most)


def test_distance_ends_early():
    """Long lines that share letters but not their order: the same answers as the whole table gives, soon for those far apart."""
    rng = random.Random(8)
    for k in range(150):
        a = "".join(rng.choice("abcdü ") for _ in range(rng.randrange(20, 130)))
        b = "".join(rng.choice("abcdü ") if rng.random() < k % 7 / 8 else x for x in a)[k % 3:len(a) - k % 5]
        whole = distance(a, b)
        for most in {0, whole // 3, whole - 1, whole, whole + 1, len(a)}:
            assert lines.distance_within(a, b, most) == (whole <= most) == lines.distance_within(b, a, most), (a, b, most)

    class Read(str):
        """A line that counts how many of its characters have been asked for one after the other."""
        seen = 0

        def __getitem__(self, at):
            return Read(super().__getitem__(at)) if isinstance(at, slice) else super().__getitem__(at)

        def __iter__(self):
            for c in super().__iter__():
                Read.seen += 1
                yield c

    a, b = ("".join(rng.choice("abcdefgh") for _ in range(2000)) for _ in range(2))
    assert not lines.distance_within("x" + a, Read("y" + b), 200)
    # Those of the first line are not counted; before, all of the second one were read.
    assert 0 < Read.seen < 1000


def test_texts_are_read_once(spark, monkeypatch):
    """The texts of named lines serve the pairs with a bucket's first and the open buckets; before, all documents were read for each."""
    calls, read = [], lines.line_texts
    monkeypatch.setattr(lines, "line_texts", lambda *a: calls.append(a) or read(*a))
    docs = [(i, " ".join(f"word{k if k % 9 else k + i}" for k in range(60))) for i in range(4)]
    got = lines.deduplicate_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert ordered(got) == ordered(brute(docs)[0]) and len(calls) == 1


def test_shared_blocks(spark):
    """Nodes by key as a plain grouping has them; keys are dealt out many to a row."""
    rng = random.Random(3)
    nodes = [(rng.getrandbits(64) - (1 << 63), [rng.choice([rng.randrange(-40, 40), rng.getrandbits(62)]) for _ in range(rng.randrange(5))]) for _ in range(300)]
    groups = {}
    for node, keys in nodes:
        for key in keys:
            groups.setdefault(key, set()).add(node)
    want = Counter((len(g), n, min(g)) for g in groups.values() if len(g) > 1 for n in g)
    frame = spark.createDataFrame(nodes, "node long, keys array<long>")
    got = lines.shared_blocks(frame).collect()
    assert Counter((r.n, r.node, r.low) for r in got) == want
    by_name = {}
    for r in got:
        by_name.setdefault(r.key, set()).add(r.node)
    assert sorted(map(sorted, by_name.values())) == sorted(map(sorted, {frozenset(g) for g in groups.values() if len(g) > 1}))
    assert lines.shared_blocks(frame.where("node IS NULL")).count() == 0


def test_joined_components(spark):
    """The same components in two steps as in one, with links between lines that had none before."""
    rng = random.Random(7)
    first, more = ([(rng.randrange(200), rng.randrange(200)) for _ in range(n)] for n in (70, 40))
    frames = [spark.createDataFrame(x, "a long, b long") for x in (first, more)]
    whole = {tuple(r) for r in lines.components(frames[0].union(frames[1])).collect()}
    got = [tuple(r) for r in lines.joined_components(lines.components(frames[0]), frames[1]).collect()]
    assert set(got) == {x for x in whole} and len(got) == len(whole)
    alone = [tuple(r) for r in lines.joined_components(lines.components(frames[0].limit(0)), frames[1].limit(0)).collect()]
    assert alone == []


def test_near_lines_are_not_compared_whole(monkeypatch):
    """One letter in every third word changed: the letters of those words are compared; before, those of both lines."""
    seen, whole = [], lines._distance
    monkeypatch.setattr(lines, "_distance", lambda a, b, most: seen.append(len(a)) or whole(a, b, most))
    words = [f"{chr(97 + k % 26)}{k}some" for k in range(90)]
    other = [w if k % 3 else w[:1] + "x" + w[2:] for k, w in enumerate(words)]
    a, b = " ".join(words), " ".join(other)
    assert lines.distance_within(a, b, 100) and max(seen) < 10
    assert lines.distance_within(a, b, 30) and not lines.distance_within(a, b, 29)


def test_folded_lines_and_word_hashes():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aB \n\t\x1f\x7fÉ\r") for _ in range(rng.randrange(40))) for _ in range(400)] + ["", "\n", " \n ", None]
    assert lines.folded_lines(pa.array(texts)) == [folded(x).encode() for t in texts for x in (t or "").split("\n")]
    long = ["x" * n for n in (1, 47, 48, 49, 70_000)] + ["".join(rng.choice("ab ") for _ in range(150_000))]

    def plain(word):
        h = 1 + len(word)
        for c in word.encode():
            h = (h * 0x9E3779B97F4A7C15 + c) % (1 << 64)
        return h

    words = Words(pa.array(long))
    got = words.hashes()
    flat = [w for t in long for w in t.split()]
    some = [k for k, w in enumerate(flat) if len(w) <= 48]
    assert len(got) == len(flat) and got[some].tolist() == lines.mix(np.array([plain(flat[k]) for k in some], np.uint64)).tolist()
