"""Substring deduplication by repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one text. Every word covered by a window whose
words also start in a text with a smaller id is removed. The steps:

1. *Anchors.* Among the phrases of ``PHRASE`` words in a window the one with the least hash is
   its anchor. Equal windows have equal anchors, so only windows whose anchor stands in texts
   of two ids can recur: about one phrase in twenty is shuffled, and all others rest.
2. *Confirmed passages.* The windows left are grouped by their hash. A window recurs if its
   texts have two ids; the least text owns it. Two neighbouring windows of the owner belong to
   one passage if each of their occurrences continues the other alike, so a text that holds
   one window of a passage holds the whole passage, and passages don't nest.
3. *Automata.* The passages, as sequences of words, are dealt to shards by the anchor of their
   first window. Each shard is compiled to an Aho-Corasick automaton of at most about
   ``SHARD_WORDS`` words; a shard with more has several.
4. *Streams.* From every text that holds such an anchor the stretch that a passage could cover
   is sent to the anchor's shard, in slots of about ``STREAM_WORDS`` words. A task reads the
   passages of a slot, compiles them, and streams the stretches through. What it finds are
   occurrences of the words themselves: hashes only decide where to look. Two different
   recurring windows whose 64-bit hashes are equal could hide one of them; nothing is ever
   removed by a hash alone.

Equal texts are reduced to one before step 1, so a text with a third of all rows takes part
once; the copies with larger ids are removed whole.

Words are separated by the characters U+0020 and U+0009 to U+000D; all others belong to words,
unchanged. Null and blank texts have no words. Rows are judged one by one: repeated rows give
repeated results, and rows of one id never remove each other. A row without id neither loses
words nor makes others lose any. An empty table gives an empty result. Other columns take no
part, whatever their names. A long text is held whole by one task at a time, with some hundred
bytes a word; a word of any length is one word.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matrixmill.llm.common import map_batches, utf8_of
from matrixmill.plans.joins import lookup_join
from matrixmill.sources.tables import checkpointed, staged

WINDOW = 50
PHRASE = 8
#: Words of the passages of one automaton, and of the texts that one task streams through it.
SHARD_WORDS = 250_000
STREAM_WORDS = 1_000_000

_FACTOR = 0x9E3779B97F4A7C15


class _Hashes(dict):
    """Hashes of words, remembered until they take about ``limit`` bytes."""

    def __init__(self, limit: int = 64 * 1024 * 1024) -> None:
        super().__init__()
        self._limit, self._size = limit, 0

    def __missing__(self, word: bytes) -> int:
        self._size += len(word) + 200
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if self._size > self._limit:
            self.clear()
            self._size = 0
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_KNOWN = _Hashes()


class _Powers:
    """Powers of an odd number modulo 2**64, computed once up to the longest text so far."""

    def __init__(self, base: int) -> None:
        self._base, self._known = np.uint64(base), np.ones(1, np.uint64)

    def __call__(self, count: int) -> np.ndarray:
        if count > len(self._known):
            powers = np.full(max(count, 2 * len(self._known)), self._base)
            powers[0] = 1
            with np.errstate(over="ignore"):
                self._known = np.cumprod(powers, dtype=np.uint64)
        return self._known[:count]


_UP, _DOWN = _Powers(_FACTOR), _Powers(pow(_FACTOR, -1, 1 << 64))


def _run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, each in constant time by sums of a polynomial."""
    count = len(hashes) - length + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * _DOWN(len(hashes)), out=sums[1:])
        mixed = (sums[length:] - sums[:-length]) * _UP(count)
        mixed ^= mixed >> np.uint64(30)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(27)
        mixed *= np.uint64(0x94D049BB133111EB)
        return mixed ^ (mixed >> np.uint64(31))


def _least_of(values: np.ndarray, spread: int) -> np.ndarray:
    """Minimum of every ``spread`` consecutive values, by runs that double."""
    size = 1
    while 2 * size <= spread:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = spread - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors_of(words: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes of a text, with the first and the last window of each."""
    phrases = _run_hashes(_KNOWN.of(words), PHRASE)
    spread = window - PHRASE + 1
    if len(phrases) < spread:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    least = _least_of(phrases, spread)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.concatenate((first[1:] - 1, [len(least) - 1]))
    return least[first], first.astype(np.int32), last.astype(np.int32)


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(id, text, sha)`` of every row."""
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return texts.withColumn("sha", F.sha2("text", 256))


def _anchored(texts: DataFrame, window: int) -> DataFrame:
    """One row per different text of enough words: least id, whether it has copies, anchors."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept, columns = [], ([], [], [])
        for row, text in enumerate(utf8_of(batch.column(1))):
            words = text.split()
            if len(words) >= window:
                kept.append(row)
                for column, values in zip(columns, anchors_of(words, window), strict=True):
                    column.append(values)
        at = pa.array(kept, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(at),
                batch.column(2).take(at),
                pa.array([x.view(np.int64) for x in columns[0]], pa.list_(pa.int64())),
                *[pa.array(column, pa.list_(pa.int32())) for column in columns[1:]],
            ],
            names=["id", "sha", "anchors", "firsts", "lasts"],
        )

    schema = f"id {kind}, sha string, anchors array<long>, firsts array<int>, lasts array<int>"
    found = map_batches(texts.filter("id IS NOT NULL"), run, schema)
    distinct = found.groupBy("sha").agg(
        F.min("id").alias("id"),
        (F.max("id") > F.min("id")).alias("copied"),
        *[F.first(name).alias(name) for name in ("anchors", "firsts", "lasts")],
    )
    return staged(distinct.withColumn("row", F.monotonically_increasing_id()), "texts")


def _marked(texts: DataFrame, anchored: DataFrame) -> DataFrame:
    """Texts with an anchor that recurs: row, id, sha, text and ``spans`` of their windows."""
    spans = anchored.select(
        "row", "id", F.explode(F.arrays_zip("anchors", "firsts", "lasts")).alias("x")
    ).select("row", "id", F.col("x.anchors").alias("anchor"), F.col("x.firsts").alias("first"), F.col("x.lasts").alias("last"))
    recurring = checkpointed(
        spans.groupBy("anchor")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .filter("least < most")
        .select("anchor")
    )
    per_row = staged(
        lookup_join(spans.drop("id"), recurring, "anchor")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("first", "last", "anchor"))).alias("spans"))
        .join(anchored.select("row", "id", "sha"), "row"),
        "spans",
    )
    keys = per_row.select("sha", "row", F.col("id").alias("least"))
    found = lookup_join(texts, keys, "sha").filter("id = least").groupBy("row").agg(F.first("text").alias("text"))
    return staged(found.join(per_row, "row"), "marked")


def _windows(marked: DataFrame, window: int) -> DataFrame:
    """Each window that may recur, with the words before and after it (0: none)."""
    kind = marked.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, text in enumerate(utf8_of(batch.column(2))):
            hashes = _KNOWN.of(text.split())
            spans = batch.column(3)[row].values
            first, last = (spans.field(name).to_numpy() for name in ("first", "last"))
            sizes = last - first + 1
            at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            bounded = np.concatenate((np.zeros(1, np.uint64), hashes, np.zeros(1, np.uint64)))
            keys = _run_hashes(hashes, window)[at]
            owner = pa.array(np.full(len(at), row, np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.view(np.int64)),
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    pa.array(at.astype(np.int32)),
                    pa.array(bounded[at].view(np.int64)),
                    pa.array(bounded[at + window + 1].view(np.int64)),
                ],
                names=["key", "row", "id", "at", "before", "after"],
            )

    schema = f"key long, row long, id {kind}, at int, before long, after long"
    return map_batches(marked.select("row", "id", "text", "spans"), run, schema)


def _passages(marked: DataFrame, window: int) -> DataFrame:
    """``(id, anchor, n_words, words)`` of the passages that recur, with their owner's id."""
    owned = (
        _windows(marked, window)
        .groupBy("key")
        .agg(
            # One of the least text's occurrences: both columns are taken from the same row.
            F.min("id").alias("least"),
            F.max("id").alias("most"),
            F.min_by("row", "id").alias("row"),
            F.min_by("at", "id").alias("at"),
            (F.bit_and("before") != F.bit_or("before")).alias("left"),
            (F.bit_and("after") != F.bit_or("after")).alias("right"),
        )
        .filter("least < most")
        .select("row", "at", "left", "right")
    )
    along = Window.partitionBy("row").orderBy("at")
    starts = F.col("left") | F.coalesce(
        (F.lag("at").over(along) != F.col("at") - 1) | F.lag("right").over(along), F.lit(True)
    )
    runs = (
        owned.withColumn("starts", starts.cast("int"))
        .withColumn("run", F.sum("starts").over(along))
        .groupBy("row", "run")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    )
    kind = marked.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        owner, rows = [], []
        for row, whole in enumerate(utf8_of(batch.column(1))):
            tokens = whole.split()
            spans = batch.column(2)[row].values
            first, anchors = spans.field("first").to_pylist(), spans.field("anchor").to_pylist()
            for passage in batch.column(3)[row].as_py():
                words = tokens[passage["first"] : passage["last"] + window]
                owner.append(row)
                rows.append((anchors[bisect_right(first, passage["first"]) - 1], len(words), b" ".join(words)))
        anchor, count, text = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(owner, pa.int32())),
                pa.array(anchor, pa.int64()),
                pa.array(count, pa.int32()),
                pa.array(text, pa.binary()).cast(pa.string()),
            ],
            names=["id", "anchor", "n_words", "words"],
        )

    joined = marked.join(runs, "row").select("id", "text", "spans", "runs")
    return staged(map_batches(joined, run, f"id {kind}, anchor long, n_words int, words string"), "passages")


def _slots(marked: DataFrame, passages: DataFrame) -> DataFrame:
    """Passages (``part`` 0) and the stretches that may hold them (``part`` 1), by slot."""
    words = passages.agg(F.sum("n_words")).first()[0] or 0
    shard = F.pmod(F.xxhash64("anchor"), F.lit(words // SHARD_WORDS + 1))
    passages = passages.withColumn("shard", shard)
    reach = checkpointed(passages.groupBy("anchor").agg(F.max("n_words").alias("reach")))
    routed = lookup_join(
        marked.select("row", F.inline("spans")).select("row", "first", "last", "anchor"), reach, "anchor"
    ).select("row", shard.alias("shard"), "first", (F.col("last") + F.col("reach")).alias("end"))
    routed = staged(routed, "routed")
    automata = passages.groupBy("shard").agg(F.expr(f"CAST(sum(n_words) div {SHARD_WORDS} + 1 AS int)").alias("automata"))
    streams = routed.groupBy("shard").agg(F.expr(f"CAST(sum(end - first) div {STREAM_WORDS} + 1 AS int)").alias("streams"))
    sizes = checkpointed(automata.join(streams, "shard"))

    dealt = lookup_join(passages, sizes, "shard").select(
        "shard",
        F.pmod(F.xxhash64("words"), F.col("automata")).cast("int").alias("automaton"),
        F.explode(F.sequence(F.lit(0), F.col("streams") - 1)).alias("stream"),
        F.lit(0).alias("part"),
        F.lit(None).cast("long").alias("row"),
        "id",
        F.lit(0).alias("start"),
        "words",
    )
    kind = marked.schema["id"].dataType.simpleString()
    schema = f"shard long, automata int, stream int, row long, id {kind}, start int, words string"

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, text in enumerate(utf8_of(batch.column(2))):
            tokens = text.split()
            stretches: list[list] = []
            for x in batch.column(3)[row].as_py():  # in order of shard and first word
                if stretches and stretches[-1][0] == x["shard"] and x["first"] <= stretches[-1][4]:
                    stretches[-1][4] = max(stretches[-1][4], x["end"])
                else:
                    stretches.append([x["shard"], x["automata"], x["streams"], x["first"], x["end"]])
            shards, automata, streams, first, end = zip(*stretches, strict=True)
            owner = pa.array(np.full(len(stretches), row, np.int32))
            number = batch.column(0)[row].as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shards, pa.int64()),
                    pa.array(automata, pa.int32()),
                    pa.array([xxhash.xxh32_intdigest(str(number)) % count for count in streams], pa.int32()),
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    pa.array(first, pa.int32()),
                    pa.array([b" ".join(tokens[a:b]) for a, b in zip(first, end, strict=True)], pa.binary()).cast(pa.string()),
                ],
                names=["shard", "automata", "stream", "row", "id", "start", "words"],
            )

    wanted = (
        lookup_join(routed, sizes, "shard")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("shard", "first", "end", "automata", "streams"))).alias("wanted"))
    )
    stretches = map_batches(marked.join(wanted, "row").select("row", "id", "text", "wanted"), run, schema).select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.col("automata") - 1)).alias("automaton"),
        "stream",
        F.lit(1).alias("part"),
        "row",
        "id",
        "start",
        "words",
    )
    return dealt.unionByName(stretches)


class _Automaton:
    """Passages of one slot, compiled when the first text arrives."""

    def __init__(self) -> None:
        self._numbers: dict[str, int] = {}
        self._found = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        self._owners: list[tuple] = []
        self._compiled = False

    def add(self, words: str, owner) -> None:
        key = tuple(self._numbers.setdefault(token, len(self._numbers) + 1) for token in words.split(" "))
        self._found.add_word(key, len(self._owners))
        self._owners.append((owner, len(key)))

    def covered(self, words: str, reader) -> list[list[int]]:
        """Word ranges of ``words`` under passages whose owner is smaller than ``reader``."""
        if not self._owners:
            return []
        if not self._compiled:
            self._found.make_automaton()
            self._compiled = True
        text = tuple(self._numbers.get(token, 0) for token in words.split(" "))
        ranges: list[list[int]] = []
        for end, number in self._found.iter(text):
            owner, length = self._owners[number]
            if owner < reader:
                start = end + 1 - length
                while ranges and ranges[-1][1] >= start:
                    start = min(start, ranges.pop()[0])
                ranges.append([start, end + 1])
        return ranges


def _locate(slots: DataFrame) -> DataFrame:
    """``(row, start, end)``: words of a text under passages of smaller ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, automaton = None, _Automaton()
        for batch in batches:
            rows, starts, ends = [], [], []
            for values in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                *own, part, row, reader, start, words = values
                if own != slot:
                    slot, automaton = own, _Automaton()
                if part == 0:
                    automaton.add(words, reader)
                    continue
                for low, high in automaton.covered(words, reader):
                    rows.append(row)
                    starts.append(start + low)
                    ends.append(start + high)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                names=["row", "start", "end"],
            )

    key = ["shard", "automaton", "stream"]
    ordered = slots.repartition(*key).sortWithinPartitions(*key, "part")
    return ordered.select(*key, "part", "row", "id", "start", "words").mapInArrow(run, "row long, start int, end int")


def _merged(found: DataFrame) -> DataFrame:
    """``(row, spans)``: the ranges of each text as ``start:end``, disjoint and in order."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = []
        for ranges in batch.column(1).to_pylist():
            merged: list[list[int]] = []
            for x in ranges:
                if merged and x["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x["end"])
                else:
                    merged.append([x["start"], x["end"]])
            texts.append(",".join(f"{start}:{end}" for start, end in merged))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "spans"])

    ranges = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("ranges"))
    return map_batches(ranges, run, "row long, spans string")


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``spans`` and ``kept_text``.

    ``spans`` are the removed word ranges ``(start, end)``, ``end`` exclusive, in order;
    ``kept_text`` are the words left, joined by one space.
    """
    if window < PHRASE:
        raise ValueError(f"A window has at least {PHRASE} words.")
    texts = _texts(docs, id_column, text_column)
    anchored = _anchored(texts, window)
    marked = _marked(texts, anchored)
    passages = _passages(marked, window)
    spans = _merged(_locate(_slots(marked, passages))).join(marked.select("row", "sha"), "row")
    changed = staged(
        anchored.filter("copied")
        .select("sha", F.col("id").alias("least"))
        .join(spans.select("sha", "spans"), "sha", "full")
        .join(marked.select("sha", F.col("id").alias("owner")), "sha", "left")
        .select("sha", F.coalesce("least", "owner").alias("least"), "spans"),
        "changed",
    )
    judged = lookup_join(texts, changed, "sha", "left").select(
        "id",
        "text",
        F.expr("CASE WHEN id > least THEN 'all' WHEN id = least THEN spans END").alias("spans"),
    )
    return _kept(judged, id_column)


def _kept(judged: DataFrame, id_column: str) -> DataFrame:
    """What is left of each text of ``(id, text, spans)``; spans may be ``all``."""
    kind = judged.schema["id"].dataType.simpleString()
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts, removed, kept = [], [], []
        for text, spans in zip(utf8_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            words = text.split()
            ranges = []
            if spans == "all":
                ranges = [(0, len(words))]
            elif spans:
                ranges = [tuple(map(int, x.split(":"))) for x in spans.split(",")]
            counts.append(len(words))
            removed.append([{"start": start, "end": end} for start, end in ranges])
            for start, end in reversed(ranges):
                del words[start:end]
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(removed, pa.list_(span)),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["id", "n_words", "spans", "kept_text"],
        )

    schema = f"id {kind}, n_words long, spans array<struct<start: int, end: int>>, kept_text string"
    return map_batches(judged, run, schema).withColumnRenamed("id", id_column)


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Numbers of words and of removed ones, and the hash of the words that are kept."""
    removed = "aggregate(spans, 0L, (total, x) -> total + x.end - x.start)"
    return found.select(
        id_column, "n_words", F.expr(removed).alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256")
    )
