import sys
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent.parent)]

import corpus_pipeline  # noqa: E402
from near import classes, near_pairs, shingle_set  # noqa: E402
from test_lines import brute as line_brute  # noqa: E402
from test_texts import WORD, removed  # noqa: E402
from test_tokens import check_packing  # noqa: E402

from inplay.llm import language, minhash, queries  # noqa: E402
from inplay.llm.common import scratch, stored  # noqa: E402


def test_pipeline(spark, sf, docs):
    """Each stage against its plain version, on what the one before it has kept."""
    found = {r.doc_id: r for r in language.identified(docs).collect()}
    texts = {i: r.text for i, r in found.items() if not r._language.rejected}
    assert len(texts) > 0.98 * len(found)
    after, _ = line_brute(sorted(texts.items()), by_keys=True)
    texts = {i: t if gone else texts[i] for i, _, gone, t in after if not gone or WORD.search(t)}
    sets = {i: shingle_set(t) for i, t in texts.items()}
    texts = {i: texts[i] for i, c in classes(sets, near_pairs(sets)).items() if i == c}
    order = sorted(texts)
    for i, (_, gone, kept) in zip(order, removed([texts[i] for i in order], 35)):
        if gone:
            texts[i] = kept
    texts = {i: t for i, t in texts.items() if t or not shingle_set(t) == set() or t is None}
    texts = {i: t for i, t in texts.items() if t is None or t != ""}
    rows = corpus_pipeline.run(spark, sf).collect()
    check_packing(rows, 4096, texts, Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER)))


def test_queries_beside_a_pipeline(spark, odd):
    """A result that was asked for before stages ran is still there after them, and repeated ids keep one row by a fixed order."""
    before = minhash.near_duplicates(odd)
    lines_before = corpus_pipeline.deduplicate_lines(spark, odd, "")
    with scratch(spark):
        one = stored(odd, "odd")
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, one, "").count()
        assert before.count() == odd.count() and lines_before.count() == lines_before.count()
    assert before.count() == odd.count()
    twice = spark.createDataFrame([(1, "some words are here", 5), (1, "other words are there", 5), (2, None, None)], "doc_id long, text string, n_chars long")
    found = {tuple(r) for n in (1, 3) for r in corpus_pipeline.drop_near_duplicates(spark, twice.repartition(n), "").collect()}
    assert len(found) == 2


def test_stages_keep_columns(spark, odd):
    """Odd rows and extra columns pass all stages."""
    rows = odd.selectExpr("*", "'y' AS _id", "2 AS _language", "3 AS _kept", "4 AS carry", "array(1) AS class_id")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, rows, ""), "stage0")
        assert out.columns == rows.columns, name
        assert out.count() <= rows.count()
        rows = out
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows.limit(0), "").count() == 0, name
