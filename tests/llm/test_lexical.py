from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from matrixmill.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(documents, items, k=10):
    """Rows of the ranking, by scoring every document for every item."""
    counts = [(key, Counter(terms(text))) for key, text in documents]
    counts = [(key, own) for key, own in counts if own]
    num, total = len(counts), sum(own.total() for _, own in counts)
    df = Counter(term for _, own in counts for term in own)
    result = []
    for item, text in items:
        wanted, scores = Counter(terms(text)), []
        for key, own in counts:
            m = 100 - 75 + (75 * own.total() * num) // total
            score = 0
            for term, many in wanted.items():
                if own[term]:
                    w = math.floor(1000 * math.log((2 * num + 2) / (2 * df[term] + 1)))
                    score += many * w * ((10**9 * own[term]) // (1000 * own[term] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        result += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scores)[:k], 1)]
    return Counter(result)


def found(spark, documents, items, **options):
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    return Counter(tuple(row) for row in lexical.search(docs, asked, **options).collect())


def corpus(seed, size=300):
    rng = random.Random(seed)
    vocabulary = [f"t{int(rng.paretovariate(0.6))}" for _ in range(2000)] + ["É", "ée", "Éa", "x-y", "ſ"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    documents = [(number, make(rng.randrange(1, 120))) for number in range(size)]
    documents += [(number + 5, documents[3][1]) for number in range(40)] + documents[:5]
    documents += [(None, documents[3][1]), (9000, ""), (9001, None), (9002, ". , -"), (9003, "t1 " * 700)]
    items = [(number, make(rng.randrange(1, 40))) for number in range(25)]
    items += [(3, items[3][1]), (77, None), (78, "nowhere"), (None, "t1 t2"), (79, documents[3][1])]
    rng.shuffle(documents)
    return documents, items


@pytest.mark.parametrize("seed", range(2))
def test_equals_scoring_everything(spark, seed):
    documents, items = corpus(seed)
    assert found(spark, documents, items) == brute_force(documents, items)


def test_batches_and_narrow_sketches(spark, monkeypatch):
    documents, items = corpus(5, 150)
    monkeypatch.setattr(lexical, "BATCH_TERMS", 60)
    monkeypatch.setattr(lexical, "_HELD_BOUNDS", 200)
    assert found(spark, documents, items, k=3) == brute_force(documents, items, 3)


def test_bounds_are_never_too_low():
    rng = np.random.default_rng(1)
    index = lexical.Index(None, None, 50, 5000)
    rows = [(q, f"t{t}", int(rng.integers(1, 9000))) for q in range(6) for t in rng.choice(400, 30, replace=False)]
    batch = lexical.make_batch(rows, index)
    for _ in range(20):
        own = Counter({b"t%d" % t: int(rng.integers(1, 400)) for t in rng.choice(400, 60, replace=False)})
        cells, peaks = lexical.sketch(own)
        n = np.array([own.total()])
        bound = lexical.bounds(batch, n, [cells.tobytes()], [peaks.tobytes()])[0]
        for query, weights in enumerate(batch.scoring):
            damping = 8 * batch.damping(own.total())
            score = sum(w * (10**9 * own[t] // (1000 * own[t] + damping)) for t, w in weights.items() if own[t])
            assert bound[query] >= score


def test_registered_query_on_the_table(spark, data, texts):
    items = [tuple(row) for row in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    rows = queries.op13_lexical_search(spark, data).collect()
    assert Counter(tuple(row) for row in rows) == brute_force(list(texts.items()), items)


def test_awkward_rows(spark, awkward, no_documents):
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()]
    items = [(1, "ONE two three"), (2, "émue 1.2.3.4"), (3, None)]
    asked = spark.createDataFrame([(*item, 0, "x") for item in items], "item_id long, text string, rank int, id string")
    result = lexical.search(awkward, asked)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(row) for row in result.collect()) == brute_force(rows, items)
    assert lexical.search(no_documents, asked).collect() == []
    assert lexical.search(awkward, asked.limit(0)).collect() == []
