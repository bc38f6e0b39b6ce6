"""Ranked lexical search with hashed max-sketches.

A document's sketch has ``WIDTH`` coordinates, of which few are used: each term falls on the
coordinate of its hash, and a coordinate keeps the largest number of occurrences of its terms.
A term's impact grows with its occurrences, so the sketch bounds the impact of every term from
above, whatever the document frequencies; it is written once and serves all queries.

1. :func:`build_index` counts the terms of every whole text, and stores the sketches and the
   document frequencies of all terms.
2. Queries are taken in batches of about ``BATCH_TERMS`` terms, which bounds what is broadcast.
   A batch is looked up in all sketches at once and gives an upper bound for every document and
   query. The documents with the ``k`` highest bounds of each query are scored exactly from
   their text; the k-th best score is the query's threshold.
3. Rescoring goes on down the bounds until the threshold: every document whose bound reaches it
   is scored exactly. All others score less than ``k`` known documents, so the result is exact.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters, only A-Z
lower-cased. Null texts have no terms; documents without terms are not counted. Every row of
``docs`` is a document of its own: repeated rows all rank. Equal scores are ranked by ascending
id, null ids last. Every row of the queries is a query of its own, too; a query without a known
term has no result, and empty tables give an empty result. Other columns take no part. A long
text is held by one task, with its different terms; a term of any length is one term.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matrixmill.llm.common import fresh_name, map_batches, segment_sums, utf8_of
from matrixmill.plans.joins import lookup_join
from matrixmill.sources.tables import checkpointed, staged

#: Coordinates of a sketch; a power of two. They are stored as pairs, so unused ones cost nothing.
WIDTH = 1 << 20
TOP = 10
#: Terms of the queries of one batch.
BATCH_TERMS = 100_000

#: Occurrences that a sketch tells apart; this many stand for any number.
_MOST = 255
#: What an impact stays below.
_LIMIT = 1_000_000
#: Document frequencies a task adds up before it passes them on: entries, and bytes of terms.
_HELD_TERMS = 300_000
_HELD_BYTES = 32 * 1024 * 1024
#: Bounds, and contributions to bounds, that a task holds at once.
_HELD_BOUNDS = 1 << 20


def _separating_table() -> bytes:
    kept = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
    return bytes(c if c in kept else 0x20 for c in range(256)).lower()


_SEPARATE = _separating_table()


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, with repeats."""
    return text.translate(_SEPARATE).split()


def coordinate(term: bytes) -> int:
    return xxhash.xxh32_intdigest(term) & (WIDTH - 1)


def sketch(counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates in use, ascending, and the largest count that falls on each."""
    at = np.fromiter(map(coordinate, counts), np.uint32, len(counts))
    many = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), _MOST).astype(np.uint8)
    order = np.argsort(at, kind="stable")
    at, many = at[order], many[order]
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[starts], np.maximum.reduceat(many, starts)


class Index(NamedTuple):
    """Stored sketches ``(id, key, n, cells, peaks)``, frequencies ``(term, df)``, and totals."""

    sketches: DataFrame
    frequencies: DataFrame
    num_documents: int
    num_terms: int


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(id, key, text)``; the key stands for id and text, and is only used to look rows up."""
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).select(
        "id", F.xxhash64("id", "text").alias("key"), "text"
    )


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Index:
    """Sketches of all documents with terms, and how many documents hold each term."""
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, key long, n long, cells binary, peaks binary, term string, df long"

    def frequencies(held: Counter, ids: pa.Array) -> pa.RecordBatch:
        # The terms are whole runs of UTF-8 bytes between ASCII characters.
        columns = [pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())]
        nothing = [pa.nulls(len(held), x) for x in (ids.type, pa.int64(), pa.int64(), pa.binary(), pa.binary())]
        return pa.RecordBatch.from_arrays([*nothing, *columns], names=names)

    names = ["id", "key", "n", "cells", "peaks", "term", "df"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ids = Counter(), 0, None
        for batch in batches:
            ids = batch.column(0)
            kept, sizes, cells, peaks = [], [], [], []
            for row, text in enumerate(utf8_of(batch.column(2))):
                terms = terms_of(text)
                if not terms:
                    continue
                counts = Counter(terms)
                known = len(held)
                held.update(counts.keys())
                size += sum(map(len, counts)) if len(held) > known else 0
                at, many = sketch(counts)
                kept.append(row)
                sizes.append(len(terms))
                cells.append(at.tobytes())
                peaks.append(many.tobytes())
                if len(held) > _HELD_TERMS or size > _HELD_BYTES:
                    yield frequencies(held, ids)
                    held, size = Counter(), 0
            at = pa.array(kept, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(at),
                    batch.column(1).take(at),
                    pa.array(sizes, pa.int64()),
                    pa.array(cells, pa.binary()),
                    pa.array(peaks, pa.binary()),
                    pa.nulls(len(kept), pa.string()),
                    pa.nulls(len(kept), pa.int64()),
                ],
                names=names,
            )
        if held:
            yield frequencies(held, ids)

    stored = staged(_keyed(docs, id_column, text_column).mapInArrow(run, schema), "index")
    sketches = stored.filter("cells IS NOT NULL").select("id", "key", "n", "cells", "peaks")
    total = sketches.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    terms = stored.filter("term IS NOT NULL").select("term", "df")
    return Index(sketches, terms, total["documents"], total["terms"] or 0)


def _query_terms(queries: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """``(query, item, term, many)``: the terms of each row of ``queries`` and how often they occur."""
    kind = queries.schema[item_column].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        owner, terms, many = [], [], []
        for row, text in enumerate(utf8_of(batch.column(2))):
            counts = Counter(terms_of(text))
            owner += [row] * len(counts)
            terms += counts.keys()
            many += counts.values()
        at = pa.array(owner, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(at),
                batch.column(1).take(at),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(many, pa.int64()),
            ],
            names=["query", "item", "term", "many"],
        )

    numbered = queries.select(
        F.monotonically_increasing_id().alias("query"),
        F.col(item_column).alias("item"),
        F.col(text_column).alias("text"),
    )
    return checkpointed(map_batches(numbered, run, f"query long, item {kind}, term string, many long"))


class Batch(NamedTuple):
    """Queries of one batch, ready to be looked up.

    ``slot_of`` leads from a coordinate to its row in the postings ``(starts, owners,
    weights)``; ``scoring`` holds each query's weight by term.
    """

    queries: np.ndarray
    slot_of: np.ndarray
    starts: np.ndarray
    owners: np.ndarray
    weights: np.ndarray
    scoring: list[dict[bytes, int]]
    num_documents: int
    num_terms: int

    def damping(self, n):
        """The length part of an impact for documents of ``n`` terms."""
        return 100 - 75 + (75 * n * self.num_documents) // self.num_terms


def make_batch(rows: list, index: Index) -> Batch:
    """Batch of ``(query, term, weight)`` rows, a weight being multiplied by the term's count."""
    numbers = {query: number for number, query in enumerate(sorted({row[0] for row in rows}))}
    scoring: list[dict[bytes, int]] = [{} for _ in numbers]
    postings: dict[int, Counter] = {}
    for query, term, weight in rows:
        word = term.encode("utf-8")
        scoring[numbers[query]][word] = weight
        postings.setdefault(coordinate(word), Counter())[numbers[query]] += weight
    slot_of = np.full(WIDTH, -1, np.int32)
    slot_of[list(postings)] = np.arange(len(postings))
    starts = np.concatenate(([0], np.cumsum([len(entry) for entry in postings.values()]))).astype(np.int64)
    owners = np.array([query for entry in postings.values() for query in entry], np.int64)
    weights = np.array([weight for entry in postings.values() for weight in entry.values()], np.int64)
    return Batch(
        np.array(list(numbers), np.int64), slot_of, starts, owners, weights, scoring, index.num_documents, index.num_terms
    )


def bounds(batch: Batch, n: np.ndarray, cells: list[bytes], peaks: list[bytes]) -> np.ndarray:
    """Upper bounds of the scores, one row per document and one column per query.

    Sums stay far below 2**53, so adding them up as doubles is exact.
    """
    lengths = np.array([len(peak) for peak in peaks], np.int64)
    slots = batch.slot_of[np.frombuffer(b"".join(cells), np.uint32)]
    hit = np.flatnonzero(slots >= 0)
    document = np.repeat(np.arange(len(lengths)), lengths)[hit]
    slots, many = slots[hit], np.frombuffer(b"".join(peaks), np.uint8)[hit].astype(np.int64)
    impact = (1_000_000_000 * many) // (1000 * many + 8 * batch.damping(n)[document])
    impact[many == _MOST] = _LIMIT
    result = np.zeros(len(lengths) * len(batch.queries))
    entries = np.diff(batch.starts)[slots]
    ends = np.cumsum(entries)
    start = 0
    while start < len(slots):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + _HELD_BOUNDS)))
        size = entries[start:end]
        skipped = np.cumsum(size) - size
        at = np.repeat(batch.starts[slots[start:end]] - skipped, size) + np.arange(size.sum())
        cell = np.repeat(document[start:end] * len(batch.queries), size) + batch.owners[at]
        value = np.repeat(impact[start:end], size) * batch.weights[at]
        low = int(cell.min())
        added = np.bincount(cell - low, value)
        result[low : low + len(added)] += added
        start = end
    return result.reshape(len(lengths), len(batch.queries))


def _bounded(shared, rows: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """First row and bounds of portions of a batch of sketches."""
    batch = shared.value
    step = max(1, _HELD_BOUNDS // len(batch.queries))
    for start in range(0, rows.num_rows, step):
        part = rows.slice(start, step)
        yield start, bounds(
            batch, part.column(2).to_numpy(), part.column(3).to_pylist(), part.column(4).to_pylist()
        )


def _highest(index: Index, shared, k: int) -> DataFrame:
    """``(query, key)`` of the documents with the ``k`` highest bounds of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(shared.value.queries)
        best, keys = np.zeros((0, size)), np.zeros((0, size), np.int64)
        for rows in batches:
            own = rows.column(1).to_numpy()
            for start, found in _bounded(shared, rows):
                candidates = np.broadcast_to(own[start : start + len(found), None], found.shape)
                best, keys = np.concatenate((best, found)), np.concatenate((keys, candidates))
                if len(best) > k:
                    top = np.argpartition(-best, k - 1, axis=0)[:k]
                    best, keys = np.take_along_axis(best, top, 0), np.take_along_axis(keys, top, 0)
        at, number = np.nonzero(best > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (shared.value.queries[number], keys[at, number], best[at, number])],
            names=["query", "key", "bound"],
        )

    found = index.sketches.mapInArrow(run, "query long, key long, bound double")
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "key")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select("query", "key")


def _reaching(index: Index, shared, thresholds: np.ndarray) -> DataFrame:
    """``(query, id, key, bound)`` of the documents whose bound reaches the query's threshold."""
    kind = index.sketches.schema["id"].dataType.simpleString()

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, found in _bounded(shared, rows):
            at, number = np.nonzero(found >= thresholds)
            owner = pa.array(at + start)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shared.value.queries[number]),
                    rows.column(0).take(owner),
                    rows.column(1).take(owner),
                    pa.array(found[at, number]),
                ],
                names=["query", "id", "key", "bound"],
            )

    return map_batches(index.sketches, run, f"query long, id {kind}, key long, bound double")


def _scored(keyed: DataFrame, wanted: DataFrame, shared) -> DataFrame:
    """``(query, id, score)`` above 0, exact, of the documents in ``wanted`` ``(query, key)``."""
    kind = keyed.schema["id"].dataType.simpleString()

    def run(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        batch = shared.value
        number_of = {query: number for number, query in enumerate(batch.queries.tolist())}
        owner, found = [], []
        for row, (text, queries) in enumerate(zip(utf8_of(rows.column(1)), rows.column(2).to_pylist(), strict=True)):
            counts = Counter(terms_of(text))
            damping = 8 * batch.damping(counts.total())
            for query in map(int, queries.split(",")):
                score = 0
                for term, weight in batch.scoring[number_of[query]].items():
                    many = counts.get(term, 0)
                    if many:
                        score += weight * ((1_000_000_000 * many) // (1000 * many + damping))
                if score:
                    owner.append(row)
                    found.append((query, score))
        query, score = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), rows.column(0).take(pa.array(owner, pa.int32())), pa.array(score, pa.int64())],
            names=["query", "id", "score"],
        )

    # A text with the queries it is wanted for: at most those of the batch.
    grouped = checkpointed(
        wanted.distinct().groupBy("key").agg(F.array_join(F.collect_list(F.col("query").cast("string")), ",").alias("queries"))
    )
    picked = lookup_join(keyed, grouped, "key").select("id", "text", "queries")
    return map_batches(picked, run, f"query long, id {kind}, score long")


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query; each task first keeps its own ``k`` best."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _weighted(terms: DataFrame, index: Index) -> DataFrame:
    """``(query, term, weight)`` of the query terms that some document holds."""
    known = lookup_join(index.frequencies, checkpointed(terms.select("term").distinct()), "term")
    df = checkpointed(known.groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log((2.0 * index.num_documents + 2) / (2.0 * F.col("df") + 1)))
    return lookup_join(terms, df, "term").select("query", "term", (F.col("many") * weight).alias("weight"))


def search(
    docs: DataFrame,
    queries: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    k: int = TOP,
) -> DataFrame:
    """The ``k`` best documents of each row of ``queries``: item id, ``rank``, id, ``score``."""
    index = build_index(docs, id_column, text_column)
    terms = _query_terms(queries, item_column, item_text)
    weighted = checkpointed(_weighted(terms, index))
    keyed = _keyed(docs, id_column, text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    spark = docs.sparkSession
    ranked = spark.createDataFrame([], f"query long, id {kind}, score long, rank int")
    batches = math.ceil(weighted.count() / BATCH_TERMS)
    for number in range(batches):
        rows = weighted.filter(F.pmod(F.xxhash64("query"), F.lit(batches)) == number).filter("weight > 0").collect()
        if not rows:
            continue
        batch = make_batch(rows, index)
        shared = spark.sparkContext.broadcast(batch)
        known = _ranked(_scored(keyed, _highest(index, shared, k), shared), k)
        thresholds = np.ones(len(batch.queries), np.int64)
        ties = [None] * len(batch.queries)
        place = {query: at for at, query in enumerate(batch.queries.tolist())}
        for row in known.filter(F.col("rank") == k).collect():
            thresholds[place[row["query"]]] = row["score"]
            ties[place[row["query"]]] = row["id"]
        # A bound equal to the threshold only matters for an id that wins the tie.
        last = spark.createDataFrame(
            list(zip(batch.queries.tolist(), thresholds.tolist(), ties, strict=True)),
            f"query long, threshold long, tie {kind}",
        )
        reaching = _reaching(index, shared, thresholds).join(F.broadcast(last), "query")
        wanted = reaching.filter("bound > threshold OR tie IS NULL OR id <= tie").select("query", "key")
        ranked = ranked.unionByName(_ranked(_scored(keyed, wanted, shared), k))
    items = terms.select("query", "item").distinct()
    named = {"id": id_column, "item": fresh_name(docs.select(id_column), item_column)}
    return lookup_join(ranked, checkpointed(items), "query").select("item", "rank", "id", "score").withColumnsRenamed(named)
