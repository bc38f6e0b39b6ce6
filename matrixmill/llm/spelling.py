"""Grouping of spelling variants by blocked Gram matrices.

Two words are near if they differ by exactly one inserted, deleted or replaced code point.
Their vectors of letter counts are then at a squared distance of 1 (lengths differ by one) or 2
(equal lengths), so products of blocks of such vectors find the pairs that need a look.

Blocks are adjacent in length: a block of length ``c`` holds words of ``c`` and of ``c + 1``
code points. A word is cut into parts of ``PART`` code points (longer ones from ``PART *
MOST_PARTS`` on), and one edit leaves all parts but one as they are. So the words of a block
also agree in all parts but one: each word enters one block per part, as the shorter and as the
longer word, at most ``2 * MOST_PARTS``. A block holds different words that differ in few code
points, at most as many as the alphabet has ways to fill them, however many rows the corpus has.
Small blocks share a product; larger ones are multiplied tile by tile, never as a whole.

Each pair at a squared distance of at most two is verified by its common prefix and suffix. A
pair may meet in several blocks, and counts in the block of the part its edit is in.

A word's *form* is its near word with the most occurrences (ties: the smallest in code-point
order), if it has at least ``DOMINANCE`` times as many; else null. The *root* is where the forms
lead in the end: they grow by that factor each step, so there are no circles.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with only A-Z lower-cased; words of
fewer than ``SHORTEST`` code points and ones that occur fewer than ``FEWEST`` times are left
out. Null texts have no words. Repeated rows count repeatedly; an empty table gives an empty
result. Other columns take no part. Long texts are counted by one task with their different
words; a word's length has no bound.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixmill.llm.common import utf8_of
from matrixmill.plans.joins import lookup_join
from matrixmill.sources.tables import checkpointed, staged

SHORTEST = 7
FEWEST = 2
DOMINANCE = 10

#: Code points of a part, and the most parts a word is cut into.
PART = 2
MOST_PARTS = 16

#: Words of one product, and cells of the arrays it works on.
_TILE = 256
_TILE_CELLS = 1 << 21
#: Different words a task counts before it passes them on: entries, and bytes of words.
_HELD_WORDS = 300_000
_HELD_BYTES = 32 * 1024 * 1024

#: The alphabet: a-z and the letters beyond, which in UTF-8 have the lead byte C3.
_RUN = re.compile(rb"(?:[a-z]|\xC3[\x80-\xBF])+")
_LETTERS = 26 + 64


def thinned(identifier: bytes, run: str, every: int = 31) -> str:
    """The run with one code point taken out, for one in ``every`` runs by checksum."""
    check = zlib.crc32(run.encode("utf-8"), zlib.crc32(identifier + b":"))
    if check % every:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1 :]


def count_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    change: Callable[[bytes, str], str] | None = None,
) -> DataFrame:
    """``(word, n)`` of all words of all whole texts.

    ``change`` maps a row's id, as text, and a run of letters to the word that counts.
    """

    def counted(held: Counter) -> pa.RecordBatch:
        columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = Counter(), 0
        for batch in batches:
            for identifier, text in zip(utf8_of(batch.column(0)), utf8_of(batch.column(1)), strict=True):
                # Shorter runs give no word: a change only takes code points out.
                runs = Counter(x for x in _RUN.findall(text.lower()) if len(x) >= SHORTEST)
                for found, many in runs.items():
                    word = found.decode("utf-8")
                    if change is not None:
                        word = change(identifier, word)
                    if len(word) >= SHORTEST:
                        if word not in held:
                            size += len(word)
                        held[word] += many
                if len(held) > _HELD_WORDS or size > _HELD_BYTES:
                    yield counted(held)
                    held, size = Counter(), 0
        if held:
            yield counted(held)

    texts = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).alias("text")
    )
    partial = texts.mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def part_size(length: int) -> int:
    return max(PART, -(-length // MOST_PARTS))


def _blocks(words: DataFrame) -> DataFrame:
    """``(length, part, key, word, n)``: the blocks of each word, as shorter and longer one."""
    size = f"greatest({PART}, CAST(ceil(c / {MOST_PARTS}) AS int))"
    entries = f"""flatten(transform(array(char_length(word), char_length(word) - 1), c ->
        transform(sequence(0, CAST(ceil(c / {size}) AS int) - 1), p -> struct(
            c AS length, p AS part,
            xxhash64(left(word, p * {size}), right(word, greatest(c - (p + 1) * {size}, 0)), c, p) AS key))))"""
    return (
        words.select("word", "n", F.expr(f"inline({entries})"))
        .filter(F.col("length") >= SHORTEST)
        .select("length", "part", "key", "word", "n")
    )


def _code_points(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and code points aligned to the left and to the right (0: none)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    joined = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
    row = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(joined)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left, right = (np.zeros((len(words), width), np.int32) for _ in range(2))
    left[row, place] = joined
    right[row, np.repeat(lengths, lengths) - 1 - place] = joined
    return lengths, left, right


def _letter_counts(left: np.ndarray) -> np.ndarray:
    row, place = np.nonzero(left)
    code = left[row, place]
    letter = np.where(code >= 0xC0, code - 0xC0 + 26, code - 0x61)
    counts = np.bincount(row * _LETTERS + letter, minlength=len(left) * _LETTERS)
    return counts.reshape(len(left), _LETTERS).astype(np.float32)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading places of the rows agree."""
    differ = a != b
    return np.where(differ.any(1), differ.argmax(1), a.shape[1])


class _Tile:
    """Rows of consecutive blocks, ready for products."""

    def __init__(self, block: np.ndarray, length: np.ndarray, part: np.ndarray, words: list[str]) -> None:
        width = max(map(len, words))
        self.block, self.length, self.part = block, length, part
        self.lengths, self.left, self.right = _code_points(words, width)
        self.counts = _letter_counts(self.left)
        self.squares = (self.counts * self.counts).sum(1)

    def near(self, other: _Tile) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the two tiles that are near, each pair once over all blocks."""
        distance = self.squares[:, None] + other.squares[None, :] - 2 * (self.counts @ other.counts.T)
        close = (distance > 0.5) & (distance < 2.5) & (self.block[:, None] == other.block[None, :])
        if self is other:
            close = np.triu(close, 1)
        a, b = np.nonzero(close)
        shorter = np.minimum(self.lengths[a], other.lengths[b])
        gap = np.abs(self.lengths[a] - other.lengths[b])
        kept = (shorter == self.length[a]) & (gap <= 1)
        a, b, shorter, gap = a[kept], b[kept], shorter[kept], gap[kept]
        width = max(self.left.shape[1], other.left.shape[1])
        before = np.minimum(_shared(_wide(self.left[a], width), _wide(other.left[b], width)), shorter)
        after = np.minimum(_shared(_wide(self.right[a], width), _wide(other.right[b], width)), shorter)
        one_edit = before + after >= shorter - (gap == 0)
        # The edit is where the common suffix ends, seen from the front.
        size = np.maximum(PART, -(-shorter // MOST_PARTS))
        part = np.maximum(-(-(shorter - after) // size) - 1, 0)
        kept = one_edit & (part == self.part[a])
        return a[kept], b[kept]


def _wide(points: np.ndarray, width: int) -> np.ndarray:
    return np.pad(points, ((0, 0), (0, width - points.shape[1]))) if points.shape[1] < width else points


def _portions(block: np.ndarray, widths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows for one product: whole blocks where they fit, else pieces of one block."""
    starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    ends = np.concatenate((starts[1:], [len(block)]))
    first = last = 0
    widest = 1
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        wide = max(widest, int(widths[start:end].max()))
        if last > first and (end - first > _TILE or (end - first) * wide > _TILE_CELLS):
            yield first, last
            first, wide = start, int(widths[start:end].max())
        last, widest = end, wide
    if last > first:
        yield first, last


def _near_rows(block: np.ndarray, length: np.ndarray, part: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that are near. Rows are sorted by block; blocks of one row are left out."""
    if not len(block):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = block[1:] == block[:-1]
    used = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
    if not len(used):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    widths = np.fromiter((len(words[at]) for at in used.tolist()), np.int64, len(used))
    found = []
    for start, end in _portions(block[used], widths):
        rows = used[start:end]
        step = max(1, min(_TILE, _TILE_CELLS // int(widths[start:end].max())))
        pieces = [rows[at : at + step] for at in range(0, len(rows), step)]
        for place, own in enumerate(pieces):
            tile = _Tile(block[own], length[own], part[own], [words[at] for at in own.tolist()])
            for others in pieces[place:]:
                other = tile
                if others is not own:
                    other = _Tile(block[others], length[others], part[others], [words[at] for at in others.tolist()])
                a, b = tile.near(other)
                found.append((own[a], others[b]))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def _near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)`` for every word and each of its near words."""
    schema = "word string, n long, other string, other_n long"

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        length, part, key = (rows.column(at).to_numpy() for at in range(3))
        change = (length[1:] != length[:-1]) | (part[1:] != part[:-1]) | (key[1:] != key[:-1])
        block = np.concatenate(([0], np.cumsum(change)))[: len(key)]
        a, b = _near_rows(block, length, part, rows.column(3).to_pylist())
        one, two = (pa.array(np.concatenate(x)) for x in ((a, b), (b, a)))
        word, n = rows.column(3).combine_chunks(), rows.column(4).combine_chunks()
        columns = [word.take(one), n.take(one), word.take(two), n.take(two)]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n", "other", "other_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last block of a batch may go on in the next one.
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [batch.column(at).to_numpy() for at in range(3)]
            other = np.flatnonzero(np.logical_or.reduce([x != x[-1] for x in ids]))
            cut = int(other[-1]) + 1 if len(other) else 0
            first = [batch.column(at)[0] for at in range(3)]
            if held and [held[-1].column(at)[0] for at in range(3)] != first:
                yield pairs(pa.Table.from_batches(held))
                held = []
            if cut:
                yield pairs(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield pairs(pa.Table.from_batches(held))

    blocks = _blocks(words).repartition("key").sortWithinPartitions("length", "part", "key")
    return blocks.mapInArrow(run, schema)


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form; each round doubles the steps taken."""
    current = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = checkpointed(
            lookup_join(current, ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), "ahead")
        )
        current = moved.select("word", "root")
        if moved.filter("ahead IS NOT NULL").isEmpty():
            return current


def group_variants(words: DataFrame) -> DataFrame:
    """One row per word of ``words`` ``(word, n)``: ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``words`` are different words of the alphabet above; those that are too short or too rare
    are left out.
    """
    vocabulary = staged(
        words.filter((F.char_length("word") >= SHORTEST) & (F.col("n") >= FEWEST)).select("word", "n"), "vocabulary"
    )
    near = (
        _near_pairs(vocabulary)
        .groupBy("word", "n")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("word"))).alias("best"),
        )
    )
    dominant = -F.col("best.minus") >= DOMINANCE * F.col("n")
    near = staged(
        near.select(
            "word",
            "n_near",
            F.when(dominant, F.col("best.word")).alias("form"),
            F.when(dominant, -F.col("best.minus")).alias("form_n"),
        ),
        "near",
    )
    roots = _roots(near.filter("form IS NOT NULL"))
    return lookup_join(vocabulary.join(near, "word", "left"), roots, "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        "form_n",
    )
