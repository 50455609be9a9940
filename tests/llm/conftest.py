import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score string, "
           "n_words string, kept string, fingerprint string, fp_ string, bucket string, predicted string")
WORDS = ("the quick brown fox jumps over a lazy dog while seven old boats drift past the quiet "
         "harbour at dawn and nobody on the pier looks up from their nets").split()
PASSAGE = " ".join(WORDS)
LONG = " ".join(f"{w}{i % 97}" for i in range(4000) for w in WORDS[:8])


def edge_rows():
    """Nulls in every column, empty and long texts, copies, repeated rows, clashing names."""
    extra = ("s", "w", "k", "f", "p", "b", "x")
    texts = [(1, PASSAGE, "en"), (2, "Before it came " + PASSAGE + " And after it went more.", "en"),
             (3, None, "en"), (4, "", None), (5, " \t\n\u000b ", "en"), (6, LONG, "en"), (7, LONG + " tail", None),
             (8, "ü漢字 😀 ▁ x\x00y <|endoftext|> #*$%&|<> 12,5", "de"), (None, PASSAGE, None), (None, None, None),
             (9, "same line\nsame line\nother", "en"), (1, PASSAGE, "en"), (1, "an id again with other words", "en")]
    return [(i, t, lang, None if i is None else "src", None if t is None else len(t), *extra) for i, t, lang in texts]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame([r[:12] for r in edge_rows()], COLUMNS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF
