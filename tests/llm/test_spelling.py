import random
import re
import zlib
from collections import Counter, defaultdict

from inplay.llm import queries, spelling


def counted(rows, typos=31):
    """Words of (id, text) rows with their counts, from the definition."""
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if typos and h % typos == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def brute(words, ratio=10):
    """Rows of (word, form, root, n, n_near, form_n) by deleting and replacing every letter."""
    near, gaps = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            short = w[:k] + w[k + 1:]
            gaps[k, short].add(w)
            if short in words:
                near[w].add(short)
                near[short].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def test_op12(spark, sf, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = queries.op12_spelling_variants(spark, sf).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(got) == len({r.word for r in got})
    assert {tuple(r) for r in got} == brute(counted(rows))


def test_variants_of_close_words(spark):
    """Many words of few letters: anagrams, doubled letters, edits at every place, long chains of forms, ties."""
    rng = random.Random(3)
    words = {}
    for base in ("aaaaaaa", "abcabcab", "ünïcödé", "mississippi", "x" * 3000):
        for _ in range(60):
            w = list(base)
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w))
                w[at:at + rng.randrange(2)] = rng.choice(["", "a", "b", "é", w[at]])
            words["".join(w)] = rng.choice([2, 2, 3, 20, 25, 250, 2500])
    # Each is ten times as often as the one before.
    words |= {"chainlink" + "s" * k: 2 * 10 ** k for k in range(12)}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(r) for r in got} == brute(words) and len(got) == len(words)
    assert {r.root for r in got if r.word.startswith("chainlink")} == {"chainlink" + "s" * 11}


def test_word_counts_odd(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(50, "Größere größere GRÖSSERE größere größere"), (50, "größere ×÷×÷×÷× ×÷×÷×÷×")]
    df = odd.unionByName(spark.createDataFrame(rows[-2:], "doc_id long, text string"), allowMissingColumns=True)
    for typos in (0, 2, 31):
        assert {tuple(r) for r in spelling.word_counts(df, typos=typos).collect()} == set(counted(rows, typos).items())
    empty = odd.limit(0)
    assert spelling.variants(spelling.word_counts(empty)).count() == 0


def test_counts_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_COUNTED", 3)
    rows = [(i, " ".join(f"wordnumber{'abcdefgh'[j]}" for j in range(i % 8 + 1))) for i in range(40)]
    got = spelling.word_counts(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {tuple(r) for r in got.collect()} == set(counted(rows, 0).items())
