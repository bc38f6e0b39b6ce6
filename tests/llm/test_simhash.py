from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from matrixmill.llm import simhash
from matrixmill.llm.components import connected_components
from matrixmill.plans import joins


def plain_fingerprint(text: str | None) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints: dict) -> dict:
    """Least key reachable over pairs of at most four differing bits."""
    root = {key: key for key in fingerprints}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    keys = sorted(fingerprints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (fingerprints[a] ^ fingerprints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {key: find(key) for key in keys}


@given(st.text(max_size=200))
@settings(max_examples=200, deadline=None)
def test_fingerprint_equals_the_definition(text):
    assert simhash.text_fingerprint(text.encode()) == plain_fingerprint(text)


def test_query_equals_brute_force(spark, documents, texts):
    found = {row["doc_id"]: row for row in simhash.near_duplicates(documents).collect()}
    fingerprints = {key: plain_fingerprint(text) for key, text in texts.items()}
    assert {key: int(row["fingerprint"], 16) for key, row in found.items()} == fingerprints
    assert {key: row["component_id"] for key, row in found.items()} == plain_components(fingerprints)
    assert all(len(row["fingerprint"]) == 16 for row in found.values())


def clustered(number: int, seed: int) -> list[int]:
    """Fingerprints in tight groups around some centres, with others far away."""
    chance = random.Random(seed)
    centres = [chance.getrandbits(64) for _ in range(5)]
    values = {chance.getrandbits(64) for _ in range(number // 4)}
    while len(values) < number:
        value = chance.choice(centres)
        for _ in range(chance.randint(0, 7)):
            value ^= 1 << chance.randrange(64)
        values.add(value)
    return sorted(values)


@pytest.mark.parametrize("distance", [1, 3, 4, 7])
@pytest.mark.parametrize("block", [40, 4096])
def test_links_span_every_pair_within_distance(spark, distance, block):
    values = np.array(clustered(400, distance), np.uint64)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    edges = [(a, b) for a, b in simhash.fingerprint_links(frame, distance, block).collect()]
    as_bits = lambda v: v & (2**64 - 1)
    assert all((as_bits(a) ^ as_bits(b)).bit_count() <= distance for a, b in edges)
    root = {int(v): int(v) for v in values}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    for a, b in edges:
        x, y = sorted((find(as_bits(a)), find(as_bits(b))))
        root[y] = x
    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance)
        assert len({find(int(values[j])) for j in near}) == 1


def test_a_crowded_key_gives_no_pair_for_every_two(spark):
    values = np.array(sorted({(1 << a) | (1 << b) for a in range(40) for b in range(40)}), np.int64)
    frame = spark.createDataFrame([(int(v),) for v in values], "fp long")
    assert simhash.fingerprint_links(frame).count() < 20 * len(values)


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7)]
    edges = spark.createDataFrame(chain, "a long, b long")
    found = {row["node"]: row["root"] for row in connected_components(edges, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_awkward_rows(awkward, no_documents):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == 9
    zeros = [row for row in rows if row["fingerprint"] == "0" * 16]
    assert len(zeros) == 4 and {row["component_id"] for row in zeros} == {1}
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert sorted(row["doc_id"] for row in kept.collect()) == [1, 3, 5, 6]
    assert simhash.near_duplicates(no_documents).collect() == []
    assert simhash.drop_near_duplicates(no_documents).collect() == []


def test_a_column_with_the_name_of_the_fingerprint_is_replaced(awkward):
    clashing = awkward.withColumnRenamed("kept", "Fingerprint")
    marked = simhash.add_fingerprints(clashing, "text")
    assert marked.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "fingerprint"]
    values = {row["text"]: row["fingerprint"] for row in marked.collect()}
    assert values[""] == values[None] == 0 and len(set(values.values())) > 2


def test_components_do_not_depend_on_how_they_are_joined(spark, monkeypatch):
    """A star of very many edges, a chain and a ring, with joins by shuffle and salted hot nodes."""
    edges = [(0, k) for k in range(1, 400)] + [(1000 + k, 1001 + k) for k in range(60)]
    edges += [(2000 + k, 2000 + (k + 1) % 30) for k in range(30)]
    frame = spark.createDataFrame(edges, "a long, b long")
    expected = {k: 0 for k in range(400)} | {1000 + k: 1000 for k in range(61)} | {2000 + k: 2000 for k in range(30)}
    monkeypatch.setattr(joins, "measured_bytes", lambda df: 1 << 40)
    monkeypatch.setattr(joins, "PIECES", 10)
    rows = connected_components(frame, "a", "b").collect()
    assert {row["node"]: row["root"] for row in rows} == expected and len(rows) == len(expected)
