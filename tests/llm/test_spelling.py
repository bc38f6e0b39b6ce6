from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from matrixmill.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def vocabulary(rows):
    counts = Counter()
    for key, text in rows:
        for found in RUN.findall(text or ""):
            word = lowered(found)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def edits(a, b):
    """Levenshtein distance, by the whole table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_force(counts):
    near = {word: [] for word in counts}
    words = sorted(counts)
    for at, a in enumerate(words):
        for b in words[at + 1 :]:
            if abs(len(a) - len(b)) <= 1 and edits(a, b) == 1:
                near[a].append(b)
                near[b].append(a)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best is not None and counts[best] >= 10 * counts[word] else None
    result = {}
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        result[word] = (form[word], root, n, len(near[word]), counts.get(form[word]))
    return result


def collected(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({row["word"] for row in rows}) == len(rows)
    return {row["word"]: tuple(row)[1:] for row in rows}


def variants(seed, letters="abé", size=40):
    """Words over a small alphabet, with many neighbours, runs of one letter and long ones."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(7, 14))) for _ in range(size)}
    words |= {"a" * n for n in range(7, 12)} | {"ab" * 40, "ab" * 40 + "a", "ab" * 39 + "bb", "abcdefgh", "abcdefhg"}
    for word in sorted(words):
        for _ in range(3):
            at = rng.randrange(len(word) + 1)
            words.add(word[:at] + rng.choice(letters) + word[at + rng.randrange(2) :])
    return {word: int(rng.paretovariate(0.4)) % 100_000 + 1 for word in words}


@pytest.mark.parametrize("seed", range(3))
def test_equals_comparing_all_pairs(spark, seed):
    counts = variants(seed)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    expected = brute_force({word: n for word, n in counts.items() if len(word) >= 7 and n >= 2})
    assert collected(spelling.group_variants(words)) == expected
    assert any(row[0] for row in expected.values())


def test_roots_follow_forms_to_the_end(spark):
    counts = {"aaaaaaaaaaaaaaaa"[:7 + k]: 10**k * 3 for k in range(8)} | {"bbbbbbb": 5, "bbbbbbc": 49, "bbbbbbd": 50}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    expected = brute_force(counts)
    assert {row[1] for word, row in expected.items() if word[0] == "a"} == {"a" * 14}
    assert collected(spelling.group_variants(words)) == expected


def test_tiles_and_batches_may_cut_blocks(spark, monkeypatch):
    block, length, part, words = [], [], [], []
    counts = variants(5, "ab", 120)
    for number, size in enumerate((7, 8)):
        for at in range(4):  # as if all words agreed in all other parts
            own = sorted(word for word in counts if len(word) in (size, size + 1))
            block += [4 * number + at] * len(own)
            length += [size] * len(own)
            part += [at] * len(own)
            words += own
    arrays = [np.array(x) for x in (block, length, part)]
    found = [frozenset((words[a], words[b])) for a, b in zip(*spelling._near_rows(*arrays, words))]
    whole = set(found)
    near = {frozenset(x) for x in itertools.combinations(set(words), 2) if edits(*x) == 1}
    # Words of 9 code points only meet shorter ones here.
    assert whole == {x for x in near if min(map(len, x)) < 9} and len(found) == len(whole)
    monkeypatch.setattr(spelling, "_TILE", 7)
    pieces = {frozenset((words[a], words[b])) for a, b in zip(*spelling._near_rows(*arrays, words))}
    assert pieces == whole and len(whole) > 10
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        frame = spark.createDataFrame([(w, n + 1) for w, n in counts.items()], "word string, n long")
        expected = brute_force({w: n + 1 for w, n in counts.items() if len(w) >= 7})
        assert collected(spelling.group_variants(frame)) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_words_are_counted_in_whole_texts(spark):
    rows = [(1, "Variant variant ÉLÈVES élèves ab1variants"), (None, "variant " * 70_000), (1, None), (2, "ß" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {row["word"]: row["n"] for row in spelling.count_words(docs, change=spelling.thinned).collect()}
    assert {word: n for word, n in found.items() if n >= 2} == vocabulary(rows)
    plain = {row["word"]: row["n"] for row in spelling.count_words(docs).collect()}
    assert plain["variant"] == 70_002 and plain["ß" * 30_000] == 1 and "ÉlÈves" not in plain


def test_registered_query_on_a_small_table(spark, tmp_path, texts):
    rows = sorted(texts.items())[:25]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = collected(queries.op11_spelling_variants(spark, str(tmp_path)))
    assert found == brute_force(vocabulary(rows)) and len(found) > 50


def test_registered_query_counts_the_whole_table(spark, data, texts):
    found = collected(queries.op11_spelling_variants(spark, data))
    assert {word: row[2] for word, row in found.items()} == vocabulary(texts.items())


def test_awkward_rows(awkward, no_documents):
    words = spelling.count_words(awkward.withColumnRenamed("score", "n"), change=spelling.thinned)
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()]
    assert collected(spelling.group_variants(words)) == brute_force(vocabulary(rows))
    assert spelling.group_variants(spelling.count_words(no_documents)).collect() == []
