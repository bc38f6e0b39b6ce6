"""Web archives as chunked record tables.

Writing takes a page as rows of record and chunk number, so the writer holds one chunk at a
time; reading yields such rows again, each with the digest and the number of payload bytes up
to its end. The last chunk of a record thus carries the digest of the whole payload. Archives
are gzipped with one member per record.

Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest id is
written as ``response``, the others as ``revisit`` records without payload that refer to it.
Smaller payloads are all written as ``response``. A null html is an empty payload; a null url
is left out of the record; a null id is smaller than any other and stays null. Of rows equal
in payload and id one is the response. An empty table gives archives without pages.

Archive files are opened by pyarrow at the folder's URI (local or shared path, HDFS, S3,
GCS); the folder must be one that all executors share. A task names its files at random and
they count only if listed in the manifest, which holds the files of tasks that ended well.
``pages`` must be a stored table: it is read twice and rows are told apart by their place. Other
columns take no part, whatever their names. A long payload is written and read in chunks.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixmill.plans.joins import lookup_join
from matrixmill.sources.tables import checkpointed

CHUNK_BYTES = 1 << 20
#: Compressed bytes after which a task begins another file; a file is read by one task.
FILE_BYTES = 256 << 20
#: Payload bytes per batch of rows that a reader hands on.
BATCH_BYTES = 8 << 20

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BREAK = b"\r\n"
_GZIP = 31

_CHUNKS = "record_id string, page_id {id}, record_type string, refers_to {id}, chunk long, " \
    "data binary, payload_bytes long, payload_digest string, last boolean"


def base32(digest: bytes) -> str:
    return b32encode(digest).decode("ascii")


def chunk_rows(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", url_column: str = "url",
               min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Pages as rows of record and chunk, with what the record's header says.

    A record has at least one row; the rows of a record follow each other in order. Only the
    digests are grouped, not the pages, and each group reaches the shuffle as one row a task.
    The digests that repeat are looked up by :func:`lookup_join`: while their measured size
    allows it they are broadcast, and no payload moves.
    """
    payload = F.encode(F.coalesce(F.col(html_column), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_column).alias("page_id"),
        F.col(url_column).alias("url"),
        payload.alias("payload"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumns({"sha1": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    repeated = checkpointed(
        rows.filter(F.col("bytes") >= min_bytes)
        .groupBy("sha1", "bytes")
        .agg(F.max(F.struct("page_id", "row")).alias("best"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("sha1", F.col("best.page_id").alias("best_id"), F.col("best.row").alias("best_row"))
    )
    revisit = F.col("best_row").isNotNull() & (F.col("best_row") != F.col("row"))
    number = F.when(revisit, 1).otherwise(F.greatest(F.ceil(F.col("bytes") / chunk_bytes), F.lit(1))).cast("int")
    typed = lookup_join(rows, repeated, "sha1", "left").withColumns({"revisit": revisit, "number": number})
    return typed.select(
        "page_id", "url", "row", "sha1", "bytes", "revisit", "best_id", "best_row", "number", "payload",
        F.explode(F.sequence(F.lit(0), F.col("number") - 1)).alias("chunk"),
    ).select(
        "page_id", "url", "row", "sha1", "bytes", "revisit", "best_id", "best_row", "number", "chunk",
        F.when(F.col("revisit"), F.lit(b"")).otherwise(
            F.substring("payload", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
        ).alias("data"),
    )


def _record_id(row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'row {row}')}>"


def _clean(value: object) -> str:
    """A header value on one line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in str(value))


def _headers(row: dict, date: str) -> bytes:
    """The record's header and the HTTP header that its block begins with."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['bytes']}\r\n\r\n"
    )
    fields = {
        "WARC-Type": "revisit" if row["revisit"] else "response",
        "WARC-Record-ID": _record_id(row["row"]),
        "WARC-Date": date,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(http) + (0 if row["revisit"] else row["bytes"]),
        "WARC-Payload-Digest": f"sha1:{base32(bytes.fromhex(row['sha1']))}",
    }
    if row["url"] is not None:
        fields["WARC-Target-URI"] = _clean(row["url"])
    if row["page_id"] is not None:
        fields["X-Page-ID"] = _clean(row["page_id"])
    if row["revisit"]:
        fields["WARC-Profile"] = PROFILE
        fields["WARC-Refers-To"] = _record_id(row["best_row"])
        if row["best_id"] is not None:
            fields["X-Refers-To-Page-ID"] = _clean(row["best_id"])
    lines = [VERSION, *[f"{name}: {value}" for name, value in fields.items()], "", ""]
    return ("\r\n".join(lines) + http).encode()


class _ArchiveWriter:
    """Writes records chunk by chunk into files of a folder, and remembers the files."""

    def __init__(self, folder: str, date: str):
        self._system, self._folder = fs.FileSystem.from_uri(folder)
        self._system.create_dir(self._folder, recursive=True)
        self._root, self._date, self._out = folder, date, None
        self.files: list[tuple[str, int, int]] = []
        self._records = self._size = 0

    def add(self, row: dict) -> None:
        if row["chunk"] == 0:
            if self._out is None or self._size >= FILE_BYTES:
                self._begin()
            self._zip = zlib.compressobj(1, zlib.DEFLATED, _GZIP)
            self._put(self._zip.compress(_headers(row, self._date)))
            self._records += 1
        self._put(self._zip.compress(row["data"]))
        if row["chunk"] == row["number"] - 1:
            self._put(self._zip.compress(_BREAK + _BREAK) + self._zip.flush())

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self._size += len(data)

    def _begin(self) -> None:
        self.close()
        self._name = f"pages-{uuid.uuid4().hex}.warc.gz"
        self._out = self._system.open_output_stream(f"{self._folder}/{self._name}", compression=None)
        self._records = self._size = 0

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self.files.append((f"{self._root.rstrip('/')}/{self._name}", self._size, self._records))
            self._out = None


def write_archives(chunks: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes :func:`chunk_rows` into archives; the manifest is ``(path, bytes, records)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _ArchiveWriter(folder, date)
        names = None
        for batch in batches:
            names = names or batch.schema.names
            for row in range(batch.num_rows):
                writer.add({name: batch.column(i)[row].as_py() for i, name in enumerate(names)})
        writer.close()
        if writer.files:
            columns = zip(*writer.files, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["path", "bytes", "records"])

    return checkpointed(chunks.mapInArrow(run, "path string, bytes long, records long"))


class _MemberStream:
    """The unzipped bytes of a file of gzip members, a piece at a time."""

    def __init__(self, source):
        self._source, self._rest, self._ready = source, b"", bytearray()
        self._zip = zlib.decompressobj(_GZIP)

    def _more(self) -> bool:
        while True:
            if self._zip.eof:
                self._rest, self._zip = self._zip.unused_data, zlib.decompressobj(_GZIP)
            if not self._rest:
                self._rest = self._source.read(CHUNK_BYTES)
                if not self._rest:
                    return False
            data = self._zip.decompress(self._rest, CHUNK_BYTES)
            self._rest = b"" if self._zip.eof else self._zip.unconsumed_tail
            if data:
                self._ready += data
                return True

    def until(self, mark: bytes) -> bytes:
        """The bytes before the next ``mark``, which is passed over; none at the end."""
        seen = 0
        while (at := self._ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self._ready)
            if not self._more():
                if self._ready:
                    raise ValueError("The archive ends within a record.")
                return b""
        found = bytes(self._ready[:at])
        del self._ready[: at + len(mark)]
        return found

    def read(self, most: int) -> bytes:
        """Up to ``most`` bytes, at least one."""
        if not self._ready and not self._more():
            raise ValueError("The archive ends within a record.")
        found = bytes(self._ready[:most])
        del self._ready[:most]
        return found


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode().split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def read_records(source, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
    """Rows of record and chunk of one archive, holding one chunk at a time."""
    stream = _MemberStream(source)
    while header := stream.until(_BREAK + _BREAK):
        own = _fields(header)
        http = stream.until(_BREAK + _BREAK)
        left = int(own["content-length"]) - len(http) - 4
        base = (own["warc-record-id"], own.get("x-page-id"), own["warc-type"], own.get("x-refers-to-page-id"))
        named = own["warc-payload-digest"].removeprefix("sha1:")
        if own["warc-type"] == "revisit":
            yield (*base, 0, b"", int(_fields(http)["content-length"]), named, True)
        else:
            digest, seen, chunk = hashlib.sha1(), 0, 0
            while True:
                data = bytearray()
                while left and len(data) < chunk_bytes:
                    data += (piece := stream.read(min(left, chunk_bytes - len(data))))
                    left -= len(piece)
                digest.update(data)
                seen += len(data)
                now = base32(digest.digest())
                if not left and now != named:
                    raise ValueError(f"Record {base[0]} has another payload than its digest says.")
                yield (*base, chunk, bytes(data), seen, now, not left)
                if not left:
                    break
                chunk += 1
        if stream.until(_BREAK + _BREAK):
            raise ValueError(f"Record {base[0]} is longer than it says.")


def read_archives(spark: SparkSession, manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """The chunked record table of the archives that ``manifest`` lists.

    Columns: ``record_id``, ``page_id``, ``record_type``, ``refers_to`` (a page id), ``chunk``,
    ``data``, ``payload_bytes`` and ``payload_digest`` up to the end of the chunk, ``last``. A
    revisit is one row with the size and digest of the payload it stands for.
    """
    schema = _CHUNKS.format(id="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in schema.split(", ")]
        types = [pa.string()] * 4 + [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_stream(name, compression=None) as source:
                    rows, size = [], 0
                    for row in read_records(source):
                        rows.append(row)
                        size += len(row[5]) + 200
                        if size >= BATCH_BYTES:
                            yield made(rows)
                            rows, size = [], 0
                    if rows:
                        yield made(rows)

    files = max(1, manifest.count())
    spread = manifest.select("path").repartition(files, "path")
    typed = {name: F.col(name).cast(id_type) for name in ("page_id", "refers_to")}
    return spread.mapInArrow(run, schema).withColumns(typed)


def payload_table(records: DataFrame) -> DataFrame:
    """One row per record, without data: its type, and the size and digest of its payload."""
    return records.filter("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
