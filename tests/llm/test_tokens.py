"""BPE and packing against the tokenizers library and against the definition of a valid packing."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from inplay.llm import bpe, packing, queries

PATH = public_tokenizers.path(queries.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n):
    rng = random.Random(7)
    letters = "aA1'sΣςİéé  \x85\x1c.,.,!<_漢字ß中ǅ½²😀\t\n"
    own = ["a<|endoftext|>b <|ENDOFTEXT|>x", "<|startoftext|>", "it's don't I'LL", "a" * 3000, "... ,.,. x.y, z.."]
    return own + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("kind", [bpe.Bpe, packing.WordIds])
def test_ids_equal_the_librarys(library, kind):
    texts = random_texts(3000)
    found = kind(PATH).encode([t.encode() for t in texts])
    assert [np.frombuffer(x, np.int32).tolist() for x in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgetting_words_changes_nothing(library):
    coder = bpe.Bpe(PATH)
    coder.remembered = 3
    texts = random_texts(50)
    for t in texts + texts:
        assert np.frombuffer(coder.encode([t.encode()])[0], np.int32).tolist() == library.encode(t, add_special_tokens=False).ids


def test_op8(spark, sf, docs, library):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = queries.op8_bpe(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_bpe_odd(odd, library):
    coded = bpe.encode(odd, PATH).withColumn("text", bpe.decode("ids", PATH)).collect()
    source = odd.collect()
    assert len(coded) == len(source)
    assert sorted(bpe.encode(odd, PATH, decoded="again").select("again").toPandas()["again"]) == sorted(r.text for r in coded)
    expected = sorted((library.encode(r.text or "", add_special_tokens=False).ids for r in source))
    assert sorted(list(r.ids) for r in coded) == expected
    assert sorted(r.text for r in coded) == sorted(library.decode(i, skip_special_tokens=False) for i in expected)
    assert bpe.encode(odd.limit(0), PATH).count() == 0


def check_packing(rows, capacity, texts, library):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        ids = library.encode(texts[doc] or "", add_special_tokens=False).ids + [1]
        own.sort(key=lambda r: r.piece)
        for k, r in enumerate(own):
            part = ids[k * capacity:(k + 1) * capacity]
            assert (r.piece, r.start, r.length, r.ids_crc32) == (k, k * capacity, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
        assert sum(r.length for r in own) == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(sequences)


def test_op1(spark, sf, docs, library):
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.op1_best_fit_packing(spark, sf).collect()
    made = check_packing(rows, 4096, texts, library)
    assert made <= np.ceil(sum(r.length for r in rows) / 4096) * 1.02 + 1


def test_packing_odd(odd, library):
    known = odd.where("doc_id IS NOT NULL")
    rows = packing.pack(packing.pieces(known, PATH, capacity=100), capacity=100).collect()
    check_packing(rows, 100, {r.doc_id: r.text for r in known.collect()}, library)
    assert packing.pack(packing.pieces(odd, PATH)).where("doc_id IS NULL").count() == 2
    assert packing.pack(packing.pieces(odd.limit(0), PATH)).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(rule):
    length = np.random.default_rng(3).integers(1, 500, 2000)
    sequence, offset = packing.best_fit(length, (1000, 4, 300_000.0), (1.0, 0.5, 0.5), rule)
    assert np.bincount(sequence, length).max() <= 1000
    assert np.bincount(sequence).max() <= 4
    assert np.bincount(sequence, length.astype(float) ** 2).max() <= 300_000
    for s in np.unique(sequence):
        own = np.flatnonzero(sequence == s)
        own = own[np.argsort(offset[own])]
        assert (offset[own] == np.concatenate([[0], np.cumsum(length[own])[:-1]])).all()
