from __future__ import annotations

import hashlib
import io
from base64 import b32encode
from gzip import decompress

import pytest

from matrixmill.llm import warc


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    rows = [
        (1, "http://a/1", "<p>same</p>", "x"),
        (2, "http://a/2", "<p>same</p>", "x"),
        (2, "http://a/2", "<p>same</p>", "x"),
        (3, None, "", "y"),
        (4, "http://a/\r\nX: 1", None, None),
        (None, "http://a/5", "no id", "z"),
        (None, "http://a/6", "no id", "z"),
        (7, "http://a/7", "é😀 \r\n\r\nWARC/1.1\r\n" * 5000, "z"),
        (8, "http://a/8", "a" * 10_000, "z"),
    ]
    path = str(tmp_path_factory.mktemp("pages") / "pages.parquet")
    spark.createDataFrame(rows, "page_id long, url string, html string, data string").coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def digest(text: str | None) -> str:
    return b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("chunk_bytes", [7, 1 << 20])
def test_round_trip(spark, pages, tmp_path, chunk_bytes):
    manifest = warc.write_archives(warc.chunk_rows(pages, chunk_bytes=chunk_bytes), f"file://{tmp_path}/archives")
    assert sum(row["records"] for row in manifest.collect()) == 9
    records = warc.read_archives(spark, manifest).collect()
    bodies: dict = {}
    for row in sorted(records, key=lambda row: row["chunk"]):
        bodies.setdefault(row["record_id"], []).append(row)
    assert len(bodies) == 9
    html = {row["page_id"]: row["html"] for row in pages.collect()}
    for parts in bodies.values():
        assert [row["chunk"] for row in parts] == list(range(len(parts)))
        assert [row["last"] for row in parts] == [False] * (len(parts) - 1) + [True]
        data, last = b"".join(row["data"] for row in parts), parts[-1]
        text = html[last["page_id"]] or ""
        assert (last["payload_bytes"], last["payload_digest"]) == (len(text.encode()), digest(text))
        assert data == (b"" if last["record_type"] == "revisit" else text.encode())
        seen = 0
        for row in parts[:-1]:
            seen += len(row["data"])
            assert row["payload_bytes"] == seen
            assert row["payload_digest"] == b32encode(hashlib.sha1(data[:seen]).digest()).decode()
    table = warc.payload_table(warc.read_archives(spark, manifest)).collect()
    kinds = sorted((str(row["page_id"]), row["record_type"], row["refers_to"]) for row in table)
    assert kinds == [
        ("1", "revisit", 2), ("2", "response", None), ("2", "revisit", 2), ("3", "revisit", 4),
        ("4", "response", None), ("7", "response", None), ("8", "response", None),
        ("None", "response", None), ("None", "revisit", None),
    ]


def test_small_payloads_are_responses(spark, pages, tmp_path):
    chunks = warc.chunk_rows(pages, min_bytes=6)
    manifest = warc.write_archives(chunks, f"file://{tmp_path}/archives")
    table = warc.payload_table(warc.read_archives(spark, manifest)).collect()
    assert {row["page_id"] for row in table if row["record_type"] == "revisit"} == {1, 2}


def test_files_are_plain_gzip_with_one_member_a_record(spark, pages, tmp_path):
    manifest = warc.write_archives(warc.chunk_rows(pages), f"file://{tmp_path}/archives")
    whole = b"".join(decompress(open(row["path"].removeprefix("file://"), "rb").read()) for row in manifest.collect())
    assert whole.count(b"WARC-Type: ") == 9 and b"\r\nX: 1" not in whole


def test_damage_is_noticed():
    rows = [{"chunk": 0, "number": 1, "data": b"abc", "row": 1, "bytes": 3, "sha1": "00" * 20, "revisit": False,
             "url": None, "page_id": 1, "best_row": None, "best_id": None}]
    head = warc._headers(rows[0], "1970-01-01T00:00:00Z")
    import gzip

    with pytest.raises(ValueError, match="another payload"):
        list(warc.read_records(io.BytesIO(gzip.compress(head + b"abc\r\n\r\n"))))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_records(io.BytesIO(gzip.compress(head + b"ab"))))


def test_query_equals_brute_force(spark, data):
    from matrixmill.llm.queries import op7_warc

    html = {row["page_id"]: row["html"] for row in spark.read.parquet(f"{data}/pages.parquet").collect()}
    best: dict[str, int] = {}
    for key, text in html.items():
        best[digest(text)] = max(key, best.get(digest(text), -1))
    expected = sorted(
        (k, len((t or "").encode()), digest(t), "response" if best[digest(t)] == k else "revisit",
         None if best[digest(t)] == k else best[digest(t)]) for k, t in html.items()
    )
    found = op7_warc(spark, data)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(tuple(row) for row in found.collect()) == expected


def test_no_pages(spark, pages, tmp_path):
    empty = spark.createDataFrame([], pages.schema)
    manifest = warc.write_archives(warc.chunk_rows(empty), f"file://{tmp_path}/archives")
    assert warc.payload_table(warc.read_archives(spark, manifest)).collect() == []
