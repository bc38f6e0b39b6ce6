"""The pipeline against a brute-force version of its stages."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from matrixmill.sources.tables import staged

from .test_exact_dedup import lowered
from .test_simhash import plain_components, plain_fingerprint


def test_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    assert contract.queries()["pipeline"] is corpus_pipeline.run


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    """What each stage returns on what the one before returned."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        results.append(staged(stage(spark, results[-1], data), name))
    return results


def texts_of(df) -> dict:
    return {row["doc_id"]: row["text"] for row in df.select("doc_id", "text").collect()}


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_exact_copies(stages):
    before, after = texts_of(stages[1]), texts_of(stages[2])
    best: dict[str, int] = {}
    for key, text in before.items():
        best[lowered(text)] = max(key, best.get(lowered(text), -1))
    assert after == {key: before[key] for key in best.values()}


def test_near_copies(stages):
    before, after = texts_of(stages[2]), texts_of(stages[3])
    roots = plain_components({key: plain_fingerprint(text) for key, text in before.items()})
    assert set(after) == set(roots.values())


def test_benchmark_leaks(spark, data, stages):
    def words(text):
        return " ".join(re.findall(r"\w+", text.lower()))

    items = [words(row["text"]) for row in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    before, after = texts_of(stages[3]), texts_of(stages[4])
    leaks = {key for key, text in before.items() if any(item in words(text or "") for item in items)}
    assert leaks <= set(before) - set(after)
    assert len(after) >= 0.98 * (len(before) - len(leaks))


def test_toxic_documents(spark, data, stages):
    toxic = {row["doc_id"]: row["toxic"] for row in spark.read.parquet(f"{data}/labels.parquet").collect()}
    before, after = texts_of(stages[0]), texts_of(stages[1])
    dropped = set(before) - set(after)
    # Too few labels here to find all, but clean documents stay.
    assert all(toxic.get(key, 1) == 1 for key in dropped)


def test_pieces_cover_every_kept_document(spark, data, stages):
    pieces = stages[5].collect()
    total = defaultdict(int)
    for row in pieces:
        total[row["doc_id"]] += row["length"]
    assert set(total) == set(texts_of(stages[4]))
    assert all(total[row["doc_id"]] == row["doc_tokens"] for row in pieces)
    assert corpus_pipeline.run(spark, data).count() == len(pieces)


def test_stages_take_awkward_rows_and_empty_tables(spark, data, awkward, no_documents):
    """Nulls, empty, long and repeated texts, ties, and columns named like results."""
    docs, kept = awkward, []
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents, data).collect() == [], name
        docs = staged(stage(spark, docs, data), name)
        kept.append(docs)
    assert all(df.columns == awkward.columns for df in kept[:-1])
    assert kept[0].count() == 9  # nothing here is toxic
    ids = [sorted((row["doc_id"] for row in df.select("doc_id").collect()), key=str) for df in kept]
    assert ids[1] == [1, 2, 4, 5, 6]  # of empty texts and of equal ones the largest id
    assert ids[2] == [1, 4, 5, 6]  # blank and empty texts share a fingerprint
    assert ids[3] == ids[2]
    assert {row["doc_id"] for row in kept[4].collect()} == set(ids[3])
    empty = kept[4].filter("doc_id = 1").collect()
    assert [(row["length"], row["doc_tokens"]) for row in empty] == [(1, 1)]
