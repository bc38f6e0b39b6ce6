from __future__ import annotations

from pathlib import Path

import pytest

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("no test tables")
    return str(DATA)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """Texts of the document table by id."""
    return {row["doc_id"]: row["text"] for row in documents.select("doc_id", "text").collect()}


#: Nulls in every column, empty, blank and long texts, repeated rows, ties, and columns with
#: the names that operators give their own results.
AWKWARD = [
    (None, None, None, None, None, None, None),
    (1, "", "en", "a", 0, 1.0, True),
    (1, "", "en", "a", 0, 1.0, True),
    (2, " \t\n ", "en", None, 4, 2.0, None),
    (3, "One two three four five six", None, "b", 27, None, False),
    (4, "ONE two three four five six", "en", "b", 27, 0.5, False),
    (None, "one two three four five six", "en", "b", 27, 0.5, False),
    (5, "long word " * 20_000 + "x" * 50_000, "en", "c", 250_000, 0.5, False),
    (6, "één émue, ÉMUE 😀 + 1.2.3.4", "fr", "c", 27, 0.5, False),
]
AWKWARD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean"
)


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("awkward") / "documents.parquet")
    spark.createDataFrame(AWKWARD, AWKWARD_SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_documents(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], AWKWARD_SCHEMA).write.parquet(path)
    return spark.read.parquet(path)
