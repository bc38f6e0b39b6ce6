from __future__ import annotations

import zlib

import numpy as np
import pytest

from matrixmill.llm import quality


def walked(forest: quality.Forest, row: np.ndarray) -> float:
    """One row down every tree, node by node."""
    total = forest.base
    for feature, cut, leaf in zip(forest.features, forest.cuts, forest.leaves, strict=True):
        node = 0
        while node < len(cut):
            node = 2 * node + 1 + int(row[feature[node]] > cut[node])
        total += leaf[node - len(cut)]
    return 1 / (1 + np.exp(-total))


def test_forest_learns_and_walks_like_single_rows():
    chance = np.random.default_rng(0)
    values = chance.normal(size=(3000, 5))
    labels = ((values[:, 0] > 0.3) ^ (values[:, 1] * values[:, 2] > 0)).astype(float)
    forest = quality.grow_forest(values[:2000], labels[:2000])
    scores = forest.scores(values)
    assert ((scores[2000:] > 0.5) == labels[2000:]).mean() > 0.9
    np.testing.assert_allclose(scores[:50], [walked(forest, row) for row in values[:50]])


@pytest.mark.parametrize("labels", [[], [1.0] * 10, [0.0] * 10])
def test_labels_of_one_kind(labels):
    forest = quality.grow_forest(np.zeros((len(labels), 3)), np.array(labels))
    score = forest.scores(np.zeros((2, 3)))
    assert len(set(score)) == 1 and (score[0] > 0.5) == (labels[:1] == [1.0])


def test_statistics():
    found = dict(zip(quality.STATISTICS, quality.statistics("One one ONE one!\nOne one ONE one!"), strict=True))
    assert found["distinct_words"] == 0.5 and found["equal_lines"] == 0.5
    assert found["next_equal"] == 0.0 and found["upper_words"] == 0.25
    assert dict(zip(quality.STATISTICS, quality.statistics("a a a"), strict=True))["next_equal"] == 2 / 3
    assert quality.statistics(" \n ") == quality.statistics("") == [0.0] * len(quality.STATISTICS)


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{data}/{name}.parquet") for name in ("documents", "labels"))
    forest = quality.fit_model(documents, labels, quality.TRAINING)
    held = labels.filter(f"NOT ({quality.TRAINING})").select("doc_id", "quality")
    rows = quality.score(documents.select("doc_id", "text"), forest).join(held, "doc_id").collect()
    right = [(row["score"] >= quality.ACCEPTED) == (row["quality"] == 1) for row in rows]
    assert len(rows) > 100 and np.mean(right) > 0.97


def test_awkward_rows(spark, awkward, no_documents):
    labels = spark.createDataFrame(
        [(1, 0, 0), (1, 0, 0), (3, 1, 0), (4, 1, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int"
    )
    forest = quality.fit_model(awkward, labels)
    scored = quality.score(awkward, forest, output="_score")
    assert scored.columns == [name for name in awkward.columns if name != "text"] + ["_score"]
    rows = scored.collect()
    assert len(rows) == 9 and all(0 <= row["_score"] <= 1 for row in rows)
    assert quality.score(no_documents, forest, output="_score").collect() == []
    nothing = quality.fit_model(no_documents, labels.limit(0))
    assert {row["_score"] for row in quality.score(awkward, nothing, output="_score").collect()} == {0.5}


def test_query_has_the_contracts_columns_and_judges_held_out_rows(spark, data):
    from matrixmill.llm.queries import op8_quality

    data = data.replace("sf0.001", "sf0.01")  # the smallest table with enough labels to learn from
    rows = op8_quality(spark, data).collect()
    known = spark.read.parquet(f"{data}/documents.parquet").select("doc_id").collect()
    assert sorted(row["doc_id"] for row in rows) == sorted(row["doc_id"] for row in known)
    labels = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{data}/labels.parquet").collect()}
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3)
    held = [row for row in rows if row["held_out"] and labels.get(row["doc_id"]) is not None]
    right = sum(row["predicted"] == labels[row["doc_id"]] for row in held)
    assert held and right >= 0.9 * len(held)


def test_a_column_with_the_name_of_the_output_is_replaced(awkward):
    forest = quality.grow_forest(np.zeros((0, len(quality.STATISTICS))), np.zeros(0))
    scored = quality.score(awkward, forest)
    assert scored.columns == ["doc_id", "lang", "source", "n_chars", "kept", "score"]
    assert {row["score"] for row in scored.collect()} == {0.5}
