from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from matrixmill.llm import crf, toxicity


def plain_marginals(scores, trans):
    """By adding up the weights of every labelling."""
    weight = np.zeros((2, len(scores)))
    for labels in itertools.product((0, 1), repeat=len(scores)):
        total = sum(s for s, y in zip(scores, labels, strict=True) if y)
        pairs = {(0, 0): 0.0, (0, 1): trans[0], (1, 0): trans[1], (1, 1): trans[2]}
        total += sum(pairs[pair] for pair in itertools.pairwise(labels))
        for at, y in enumerate(labels):
            weight[y, at] += np.exp(total)
    return weight[1] / weight.sum(0)


def test_marginals_equal_enumeration():
    chance = np.random.default_rng(1)
    lengths = np.array([1, 5, 3, 1, 7, 2])
    scores = chance.normal(0, 2, lengths.sum())
    trans = crf.Transitions(-0.7, 0.4, 1.3)
    found = crf.marginals(scores, lengths, trans)
    ends = np.cumsum(lengths)
    for end, length in zip(ends, lengths, strict=True):
        np.testing.assert_allclose(found[end - length : end], plain_marginals(scores[end - length : end], trans))
    assert len(crf.marginals(np.zeros(0), np.zeros(0, np.int64), trans)) == 0


def test_fit_finds_the_slope_zero():
    chance = np.random.default_rng(2)
    lengths = np.full(200, 6)
    features = chance.integers(0, 4, 1200)
    labels = (chance.random(1200) < np.array([0.1, 0.3, 0.6, 0.9])[features]).astype(int)
    weights, trans = crf.fit(np.arange(1200), features, 4, labels, lengths, penalty=1e-3, rounds=400, step=0.1)
    found = crf.marginals(weights[features], lengths, trans)
    for number in range(4):  # at the optimum, expected and seen counts agree
        own = features == number
        assert found[own].mean() == pytest.approx(labels[own].mean(), abs=0.01)


WORDS = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta", "losesta", "zeta"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents whose toxic words have stems with many endings, or one form."""
    chance = random.Random(3)
    docs, labels = [], []
    for number in range(400):
        words = [chance.choice(WORDS) + chance.choice("abcdefgh") for _ in range(chance.randint(5, 60))]
        toxic = number % 5 == 0
        if toxic:
            for _ in range(3):
                bad = chance.choice(["loser", "grumbl" + "".join(chance.choices("aeiou", k=3))])
                words[chance.randrange(len(words))] = bad
        text = " ".join(f"{w}." if chance.random() < 0.15 else w for w in words)
        docs.append((number, text))
        labels.append((number, 1, int(toxic)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return docs, frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.fit_model(corpus[1], corpus[2], toxicity.TRAINING)


def test_held_out_documents_and_spans(corpus, model):
    docs, frame, _ = corpus
    for row in toxicity.tag(frame, model).collect():
        text = dict(docs)[row["doc_id"]]
        assert (row["score"] >= toxicity.REJECTED) == (row["doc_id"] % 5 == 0), text
        for span in row["spans"]:
            assert all(w.strip(".").startswith(("loser", "grumbl")) for w in text[span["start"] : span["end"]].split())


def test_new_endings_are_toxic_and_look_alikes_are_not(spark, model):
    cases = [("Grumblxyz!", True), ("the GRUMBLooo, there", True), ("losesta losestab", False), ("lose", False), ("", False)]
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "doc_id long, text string")
    found = {row["doc_id"]: row["score"] >= 0.7 for row in toxicity.tag(frame, model).collect()}
    assert found == {i: toxic for i, (_, toxic) in enumerate(cases)}


def test_copies_are_no_evidence(spark):
    docs = [(i, "rareword stands here alone") for i in range(100)] + [(i, f"plain text number{i}") for i in range(100, 400)]
    labels = [(i, 1, int(i < 100)) for i in range(400)]
    model = toxicity.fit_model(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    assert model.weights == {}


def test_awkward_rows(spark, model, awkward, no_documents):
    tagged = toxicity.tag(awkward, model, score="_score", spans="_spans")
    assert tagged.columns == [*awkward.columns, "_score", "_spans"]
    rows = tagged.collect()
    assert len(rows) == 9 and all(0 <= row["_score"] <= 1 for row in rows)
    assert {row["_score"] for row in rows if not (row["text"] or "").strip()} == {0.0}
    kept = toxicity.drop_toxic(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == 9
    assert toxicity.drop_toxic(no_documents, model).collect() == []
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty = toxicity.fit_model(no_documents, nothing)
    assert {row["score"] < 1e-9 for row in toxicity.tag(awkward.select("doc_id", "text"), empty).collect()} == {True}
    odd = spark.createDataFrame([(None, 1, 1), (5, None, None), (6, 1, 1), (6, 0, 0)], nothing.schema)
    assert toxicity.fit_model(awkward, odd).weights == {}


def test_query_has_the_contracts_columns_and_judges_held_out_rows(spark, data, texts):
    from matrixmill.llm.queries import op9_toxicity

    rows = op9_toxicity(spark, data).collect()
    assert {row["doc_id"] for row in rows} == set(texts) and len(rows) == len(texts)
    labels = {row["doc_id"]: row["toxic"] for row in spark.read.parquet(f"{data}/labels.parquet").collect()}
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7)
        assert all(0 <= x["start"] < x["end"] <= len(texts[row["doc_id"]]) for x in row["spans"])
    held = [row for row in rows if row["held_out"] and labels.get(row["doc_id"]) == 0]
    assert held and sum(row["predicted"] for row in held) <= 0.1 * len(held)


def test_columns_with_the_names_of_outputs_are_replaced(awkward):
    model = toxicity.ToxicityModel({}, -50.0, crf.Transitions(0.0, 0.0, 0.0))
    tagged = toxicity.tag(awkward.withColumnRenamed("kept", "Spans"), model)
    assert tagged.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "spans"]
    assert all(row["score"] < 1e-9 and row["spans"] == [] for row in tagged.collect())
