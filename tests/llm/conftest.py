import pytest


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


#: Texts that every operator has to take: null, empty, blank, repeated, no letters, one very long word, very many words.
ODD = [None, "", "   \n\t ", "same text here", "same text here", "12345 %% !!", "x" * 30_000, "word " * 30_000,
       "ünï cödé wörter\nzwei  zeilen", "a\x0bb\x0cc\rd\x85e f"]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts, two rows without id, and columns whose names clash with the operators' own."""
    rows = [(i, t, "en", f"src{i % 2}", None if t is None else len(t)) for i, t in enumerate(ODD)] + [(None, "no id", None, None, 5)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "'x' AS id", "1 AS key", "2 AS band", "3 AS chunk", "'k' AS kept", "0L AS length", "0 AS _group", "1 AS n_words")
