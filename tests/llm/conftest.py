import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty and long texts, repeated rows and extra
    columns whose names the operators use themselves."""
    long_text = "many words in one long text " * 20_000
    prose = ("the of and to a in is that it for was on with as be by this are at from " * 4).strip()
    rows = [
        (1, prose, "en", "s", 5, 0.5, "x"), (1, prose, "en", "s", 5, 0.5, "x"), (2, prose, None, None, None, None, None),
        (None, prose, "en", "s", 5, 0.5, "x"), (3, None, "en", "s", 0, 0.5, "x"), (4, "", "en", "s", 0, 0.5, "x"),
        (5, " \t\n ", "de", "s", 3, 0.5, "x"), (6, long_text, "en", "s", 9, 0.5, "x"), (7, "a", "xx", "s", 1, 0.5, "x"),
        (None, None, None, None, None, None, None), (8, "漢字 🙂 <|endoftext|>   é", "fr", "s", 9, 0.5, "x"),
    ]
    # kept, score and fingerprint are names of operators' own columns
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score double, fingerprint string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
