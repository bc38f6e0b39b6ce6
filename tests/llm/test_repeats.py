from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from matrixmill.llm import queries, repeats


def brute_force(rows, window=repeats.WINDOW):
    """Id, words, removed words and hash of the kept ones, by looking at every window."""
    split = [(key, (text or "").encode().split()) for key, text in rows]
    least: dict[tuple, int] = {}
    for key, words in split:
        for at in range(len(words) - window + 1):
            if key is not None:
                run = tuple(words[at : at + window])
                least[run] = min(least.get(run, key), key)
    result = []
    for key, words in split:
        gone = set()
        for at in range(len(words) - window + 1):
            if key is not None and least[tuple(words[at : at + window])] < key:
                gone.update(range(at, at + window))
        kept = b" ".join(word for at, word in enumerate(words) if at not in gone)
        result.append((key, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(result)


def found(docs, **options):
    return Counter(tuple(row) for row in repeats.digest(repeats.remove_repeats(docs, **options)).collect())


def passages(seed: int, size: int = 120):
    """Texts put together from a few passages, cut and changed at random."""
    rng = random.Random(seed)
    pool = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(30, 200))] for _ in range(12)]
    rows = []
    for number in range(size):
        words: list[str] = []
        for _ in range(rng.randrange(1, 5)):
            piece = list(rng.choice(pool))
            cut = rng.randrange(len(piece))
            piece = piece[cut:] if rng.random() < 0.3 else piece[: cut + 60]
            if rng.random() < 0.5:
                piece[rng.randrange(len(piece))] = f"x{rng.randrange(1000)}"
            words += piece + [f"y{rng.randrange(100_000)}" for _ in range(rng.randrange(4))]
        rows.append((rng.choice([number, number // 2, None]) if rng.random() < 0.1 else number, " ".join(words)))
    rows += [(size, "again " * 400), (size + 1, "again " * 130), (size + 2, "a b " * 90), (size + 3, "b a " * 90)]
    rows += rows[:7] + [(size + 9, rows[3][1]), (-1, rows[4][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_looking_at_every_window(spark, seed):
    rows = passages(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs) == brute_force(rows)


def test_many_small_automata_and_streams(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_WORDS", 300)
    monkeypatch.setattr(repeats, "STREAM_WORDS", 500)
    rows = passages(7)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute_force(rows)


def test_shorter_windows_and_other_ids(spark):
    rows = passages(8, 60)
    docs = spark.createDataFrame([(text, None if key is None else f"k{key:06}") for key, text in rows], "t string, k string")
    named = [(None if key is None else f"k{key:06}", text) for key, text in rows]
    assert found_named(docs) == brute_force(named, 12)
    with pytest.raises(ValueError, match="window"):
        repeats.remove_repeats(docs, "k", "t", window=3)


def found_named(docs):
    result = repeats.digest(repeats.remove_repeats(docs, "k", "t", window=12), "k")
    return Counter(tuple(row) for row in result.collect())


def test_registered_query_on_the_table(spark, data, documents, texts):
    rows = queries.op12_substring_dedup(spark, data).collect()
    assert Counter(tuple(row) for row in rows) == brute_force(list(texts.items()))


def test_spans_and_text(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"a {shared} b"), (2, f"c\td {shared}\n e")], "doc_id long, text string")
    rows = {row["doc_id"]: row for row in repeats.remove_repeats(docs).collect()}
    assert rows[1]["spans"] == [] and rows[1]["kept_text"] == f"a {shared} b" and rows[1]["n_words"] == 62
    assert [tuple(x) for x in rows[2]["spans"]] == [(2, 62)] and rows[2]["kept_text"] == "c d e"


def test_awkward_rows(awkward, no_documents):
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()]
    assert found(awkward) == brute_force(rows)
    assert found(no_documents) == Counter()
