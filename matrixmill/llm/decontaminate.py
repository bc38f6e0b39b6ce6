"""Benchmark decontamination by spaced seeds.

A seed is a mask over consecutive words that compares some positions and ignores the rest,
so a passage with substituted words still has hits. The seeds of the benchmark form an index
that every task looks the seeds of its documents up in; the documents do not move. Each hit
puts a document and an item on a diagonal (their words side by side). A document is
contaminated by the item if ``WINDOW`` consecutive words of the diagonal, or the whole item if
it is shorter, agree in at least ``AGREEMENT`` of the words. The masks are chosen such that
every such agreement, wherever its substitutions are, has a hit: six masks for items from
``LONG_ITEM`` words on, four denser ones for shorter items.

The index of one pass has about ``SLICE_WORDS`` words of the benchmark; a larger benchmark is
taken in slices, with one pass over the documents per slice, so what is broadcast is bounded by
that and by the longest item, whatever the benchmark's size. Results don't depend on the slices.

Words are separated by white space, without punctuation at their ends, in lower case. Null
texts have no words. Items of fewer than ``SHORTEST_ITEM`` words are not searched: so few
words are no evidence. Items equal in id are one item, which the best of their overlaps counts
for. Repeated rows of documents are each judged; empty tables give an empty result. Other
columns take no part, whatever their names. Long texts are searched whole, in portions of whole
texts; a long item is one entry of the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from matrixmill.llm.common import TokenTable, map_batches, segment_sums, texts_of
from matrixmill.sources.tables import checkpointed, staged

# The masks, 1 where words are compared.
MASKS = ("111111", "1101111", "10111011", "11100111", "110101011", "111010011")
SHORT_MASKS = ("1111", "10111", "11011", "11101")

WINDOW = 13
AGREEMENT = 0.8
SHORTEST_ITEM = 5
LONG_ITEM = 8

#: Words of the benchmark that one pass looks up.
SLICE_WORDS = 1_000_000

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’„…–—¿¡"
_FILTER_FACTOR = 64


def _describe(token: str) -> tuple[int]:
    word = token.strip(_EDGES).lower()
    return (xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) if word else 0,)


def _words(text: str) -> np.ndarray:
    """64-bit hashes of a text's words."""
    hashes = _KNOWN.values(text.split())[0]
    return hashes[hashes != 0]


_ALL_MASKS = (*MASKS, *SHORT_MASKS)
_FACTORS = np.array(
    [xxhash.xxh64_intdigest(str(at)) | 1 for at in range(max(map(len, _ALL_MASKS)) + 1)], np.uint64
)


def _masks_of(length: int) -> range:
    """Numbers of the masks that an item of so many words is looked up by."""
    return range(len(MASKS)) if length >= LONG_ITEM else range(len(MASKS), len(_ALL_MASKS))


def _seeds(words: np.ndarray, number: int) -> np.ndarray:
    """Hashes of one mask at every position where it fits."""
    mask = _ALL_MASKS[number]
    count = len(words) - len(mask) + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    total = np.full(count, np.uint64(number + 1))
    with np.errstate(over="ignore"):
        for at, kept in enumerate(mask):
            if kept == "1":
                total += words[at : at + count] * _FACTORS[at]
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


class SeedIndex(NamedTuple):
    """Items with their words, and their seeds in sorted order with item and position."""

    names: list
    words: list[np.ndarray]
    masks: list[int]
    seeds: np.ndarray
    item_of: np.ndarray
    position_of: np.ndarray


def build_index(rows: list) -> SeedIndex:
    """Index of ``(item, words)`` rows."""
    items = [np.array(row[1], np.int64).view(np.uint64) for row in rows]
    seeds, item_of, position_of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    masks = set()
    for number, words in enumerate(items):
        for mask in _masks_of(len(words)):
            found = _seeds(words, mask)
            masks.add(mask)
            seeds.append(found)
            item_of.append(np.full(len(found), number, np.int32))
            position_of.append(np.arange(len(found), dtype=np.int32))
    joined = [np.concatenate(x) for x in (seeds, item_of, position_of)]
    order = np.argsort(joined[0], kind="stable")
    return SeedIndex([row[0] for row in rows], items, sorted(masks), *[x[order] for x in joined])


def _filter(seeds: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    bits = max(12, (len(seeds) * _FILTER_FACTOR).bit_length())
    shift = np.uint64(64 - bits)
    table = np.zeros(1 << bits, bool)
    table[seeds >> shift] = True
    return table, shift


def _diagonals(
    words: np.ndarray, lengths: np.ndarray, index: SeedIndex, table: np.ndarray, shift: np.uint64
) -> dict[int, set[tuple[int, int]]]:
    """For each document the ``(item, shift)`` of every seed that it shares with an item.

    ``words`` are those of all documents, one after the other.
    """
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    found: dict[int, set[tuple[int, int]]] = {}
    for number in index.masks:
        seeds = _seeds(words, number)
        at = np.flatnonzero(table[seeds >> shift])
        at = at[owner[at] == owner[at + len(_ALL_MASKS[number]) - 1]]  # not across two documents
        first = np.searchsorted(index.seeds, seeds[at], "left")
        last = np.searchsorted(index.seeds, seeds[at], "right")
        hit = last > first
        for place, low, high in zip(at[hit], first[hit], last[hit], strict=True):
            row = int(owner[place])
            shifts = place - starts[row] - index.position_of[low:high]
            found.setdefault(row, set()).update(
                zip(index.item_of[low:high].tolist(), shifts.tolist(), strict=True)
            )
    return found


def overlap(words: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """First word, end and agreeing words of the best overlap on a diagonal, if there is one.

    An overlap is a run of windows that agree and touch; the best has the most agreeing
    words, the first of equal ones.
    """
    low, high = max(0, shift), min(len(words), shift + len(item))
    span = min(WINDOW, len(item))
    if high - low < span:
        return None
    agree = words[low:high] == item[low - shift : high - shift]
    total = np.concatenate(([0], np.cumsum(agree)))
    good = np.flatnonzero(total[span:] - total[:-span] >= AGREEMENT * span)
    if not len(good):
        return None
    cuts = np.flatnonzero(np.diff(good) > span)
    starts = good[np.concatenate(([0], cuts + 1))]
    ends = good[np.concatenate((cuts, [len(good) - 1]))] + span
    sums = total[ends] - total[starts]
    best = int(np.argmax(sums))
    return low + int(starts[best]), low + int(ends[best]), int(sums[best])


def _benchmark_items(benchmark: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """``(item, words)``: the items of enough words."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        owner, items = [], []
        for row, text in enumerate(texts_of(batch.column(1))):
            words = _words(text)
            if len(words) >= SHORTEST_ITEM:
                owner.append(row)
                items.append(words.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(owner, pa.int32())), pa.array(items, pa.list_(pa.int64()))],
            names=["item", "words"],
        )

    kind = benchmark.schema[item_column].dataType.simpleString()
    pairs = benchmark.select(F.col(item_column).alias("item"), F.col(text_column).alias("text"))
    return map_batches(pairs, run, f"item {kind}, words array<long>")


def _slices(items: DataFrame) -> Iterator[SeedIndex]:
    """Indexes of about ``SLICE_WORDS`` words each."""
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    number = -(-total // SLICE_WORDS)
    for at in range(number):
        chosen = items.filter(F.pmod(F.xxhash64("words"), F.lit(number)) == at) if number > 1 else items
        rows = chosen.distinct().collect()
        if rows:
            yield build_index(rows)


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document row and item it overlaps with: the best overlap.

    Columns: id, item id, ``start_word``, ``end_word`` (exclusive), ``agreeing_words``.
    """
    items = checkpointed(_benchmark_items(benchmark, item_column, item_text))
    item_kind = benchmark.schema[item_column].dataType.simpleString()
    id_kind = docs.schema[id_column].dataType.simpleString()
    schema = StructType.fromDDL(
        f"row long, id {id_kind}, item {item_kind}, start_word long, end_word long, agreeing_words long"
    )
    arrow = to_arrow_schema(schema)
    pairs = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text")
    )
    found = []
    for index in _slices(items):
        if len(found) == 1:
            # The rows need the same numbers in every pass.
            pairs = staged(pairs, "documents")
            found = [map_batches(pairs, _search(docs.sparkSession, first, arrow), schema)]
        first = index
        found.append(map_batches(pairs, _search(docs.sparkSession, index, arrow), schema))
    result = reduce(DataFrame.unionByName, found or [docs.sparkSession.createDataFrame([], schema)])
    if len(found) > 1:
        # Equal ids of items may lie in several slices.
        spot = F.struct("agreeing_words", (-F.col("start_word")).alias("start"), (-F.col("end_word")).alias("end"))
        result = (
            result.groupBy("row", "item")
            .agg(F.max(spot).alias("best"), F.first("id").alias("id"))
            .select(
                "id",
                "item",
                (-F.col("best.start")).alias("start_word"),
                (-F.col("best.end")).alias("end_word"),
                "best.agreeing_words",
            )
        )
    return result.drop("row").withColumnsRenamed({"id": id_column, "item": item_column})


#: Words of whole texts that are looked up at once; it bounds memory, not results.
PORTION_WORDS = 100_000

#: Words known to a worker process, whatever the benchmark.
_KNOWN = TokenTable(_describe, (np.uint64,))


def _portions(column: pa.Array) -> Iterator[tuple[int, list[list[str]]]]:
    """Split texts in runs of about ``PORTION_WORDS``, each with the place of its first text."""
    first, size, tokens = 0, 0, []
    for text in texts_of(column):
        tokens.append(text.split())
        size += len(tokens[-1])
        if size >= PORTION_WORDS:
            yield first, tokens
            first, size, tokens = first + len(tokens), 0, []
    if tokens:
        yield first, tokens


def _best_overlaps():
    """Function that gives each text's longest overlap per item, for texts that have any."""
    state: dict[str, tuple] = {}

    def run(shared: SeedIndex, column: pa.Array) -> dict[int, dict[object, tuple[int, int, int]]]:
        if not state:
            state["filter"] = _filter(shared.seeds)
        result: dict[int, dict[object, tuple[int, int, int]]] = {}
        for first, tokens in _portions(column):
            hashes = _KNOWN.values([token for own in tokens for token in own])[0]
            real = hashes != 0
            counts = np.array([len(own) for own in tokens], np.int64)
            lengths = segment_sums(real, counts)
            words, starts = hashes[real], np.cumsum(lengths) - lengths
            for row, diagonals in _diagonals(words, lengths, shared, *state["filter"]).items():
                own, best = words[starts[row] : starts[row] + lengths[row]], {}
                for number, at in diagonals:
                    spot = overlap(own, shared.words[number], at)
                    item = shared.names[number]
                    # Of equal overlaps the first one counts.
                    if spot and (item not in best or (-spot[2], spot) < (-best[item][2], best[item])):
                        best[item] = spot
                if best:
                    result[first + row] = best
        return result

    return run


def _search(spark: SparkSession, index: SeedIndex, schema: pa.Schema):
    shared, best_overlaps = spark.sparkContext.broadcast(index), _best_overlaps()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        owner, rows = [], []
        for row, best in sorted(best_overlaps(shared.value, batch.column(2)).items()):
            owner += [row] * len(best)
            rows += [(item, *spot) for item, spot in best.items()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(at).take(pa.array(owner, pa.int32())) for at in range(2)],
                *[pa.array(values, kind) for values, kind in zip(columns, schema.types[2:], strict=True)],
            ],
            schema=schema,
        )

    return run


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without any overlap, columns unchanged."""
    unnamed = benchmark.select(F.lit(0).alias("item"), F.col(item_text).alias("text"))
    items = checkpointed(_benchmark_items(unnamed, "item", "text"))
    at = docs.columns.index(text_column)
    kept = docs
    for index in _slices(items):
        shared, best_overlaps = docs.sparkSession.sparkContext.broadcast(index), _best_overlaps()

        def run(batch: pa.RecordBatch, shared=shared, best_overlaps=best_overlaps) -> Iterator[pa.RecordBatch]:
            clean = np.ones(batch.num_rows, bool)
            clean[list(best_overlaps(shared.value, batch.column(at)))] = False
            yield batch.filter(pa.array(clean))

        kept = map_batches(kept, run, kept.schema)
    return kept
