from __future__ import annotations

import hashlib

import pytest

from matrixmill.llm import exact_dedup


def lowered(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_awkward_rows(awkward, no_documents):
    marked = exact_dedup.mark_copies(awkward)
    assert marked.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    rows = marked.collect()
    assert len(rows) == 9
    groups: dict[str, list] = {}
    for row in rows:
        groups.setdefault(row["text_sha256"], []).append(row)
    empty = groups[hashlib.sha256(b"").hexdigest()]
    assert [row["group_size"] for row in empty] == [3, 3, 3]
    assert sum(row["kept"] for row in empty) == 1 and {row["keep_id"] for row in empty} == {1}
    words = groups[hashlib.sha256(b"one two three four five six").hexdigest()]
    assert sorted((str(row["doc_id"]), row["kept"]) for row in words) == [("3", False), ("4", True), ("None", False)]
    assert exact_dedup.mark_copies(no_documents).collect() == []


def test_dropping_keeps_rows_whole(awkward, no_documents):
    kept = exact_dedup.drop_copies(awkward)
    assert kept.columns == awkward.columns
    assert sorted(row["doc_id"] for row in kept.collect()) == [1, 2, 4, 5, 6]
    assert {tuple(row) for row in kept.collect()} <= {tuple(row) for row in awkward.collect()}
    assert exact_dedup.drop_copies(no_documents).collect() == []


@pytest.mark.parametrize("most", [1024, exact_dedup.MAX_CELLS])
def test_a_filter_that_is_too_small_loses_nothing(documents, texts, monkeypatch, most):
    monkeypatch.setattr(exact_dedup, "MAX_CELLS", most)
    best: dict[str, int] = {}
    for key, text in texts.items():
        best[lowered(text)] = max(key, best.get(lowered(text), -1))
    rows = exact_dedup.mark_copies(documents).collect()
    assert {row["doc_id"]: row["keep_id"] for row in rows} == {k: best[lowered(t)] for k, t in texts.items()}
    assert sum(row["kept"] for row in rows) == len(best)


@pytest.mark.parametrize("most", [1024, exact_dedup.MAX_CELLS])
def test_the_filter_stays_sharp_when_its_parts_are_small(spark, monkeypatch, most):
    """A tenth of the rows have copies, and hardly more are flagged, with many parts or one."""
    monkeypatch.setattr(exact_dedup, "MAX_CELLS", most)
    keys = [(f"k{i}", i) for i in range(9000)] + [(f"c{i % 500}", i) for i in range(1000)]
    frame = spark.createDataFrame(keys, "key string, hash_0 int")
    flagged = exact_dedup.flag_possible_copies(frame, "key", "flag")
    rows = flagged.collect()
    assert flagged.columns == ["key", "hash_0", "flag"]
    assert sorted((row["key"], row["hash_0"]) for row in rows) == sorted(keys)
    hit = [row["key"] for row in rows if row["flag"]]
    assert sum(key.startswith("c") for key in hit) == 1000
    assert len(hit) - 1000 < 0.03 * 9000
    assert exact_dedup.filter_size(500)[0] == (8 if most == 1024 else 1)


def test_only_possible_copies_are_flagged(spark):
    keys = [(f"k{i}",) for i in range(2000)] + [("k1",), ("k1",), ("k7",)]
    flagged = exact_dedup.flag_possible_copies(spark.createDataFrame(keys, "key string"), "key", "flag")
    hit = [row["key"] for row in flagged.filter("flag").collect()]
    assert hit.count("k1") == 3 and hit.count("k7") == 2
    assert len(hit) < 5 + 0.05 * len(keys)
