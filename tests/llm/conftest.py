import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, shard int, spans array<int>, rep string, p string, `a.b` string, __q_text string, __q_id long, __q_spans array<int>, __q_hit boolean, __q_gone long, __q_p double, __q_0 int, c0 string, again long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), "h", 1, [1], "r", "p", "dot", "q", 1, [2], True, 3, 0.1, 4, "c", 5)


LONG = " ".join(f"word{i % 977} x{i}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and more columns whose names the operators use inside."""
    rows = [row(1, None), row(2, ""), row(3, "   \n\n  "), row(4, "!?"), row(5, "one"), row(5, "one"), row(None, PASSAGE + " null id"), row(6, LONG), row(7, "a b " + PASSAGE + " c"), row(8, "d e " + PASSAGE), row(9, PASSAGE, None, None), (10, "naïve ÉTÉ — 中文 🙂 it's", *[None] * 18), row(11, "x " * 300), row(12, "x " * 300)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (7, None, None), (None, 1, 1), (8, 0, 1), (8, 1, 0), (999, 0, 1)], "doc_id long, quality int, toxic int")
