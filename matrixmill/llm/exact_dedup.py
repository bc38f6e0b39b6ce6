"""Exact deduplication by two passes over a Bloom filter, with built-in functions only.

Pass 1 hashes every row to 64 bits and counts the rows of each hash. What is shuffled is one
number per row and task, never a text. The hashes that occur twice or more are put into a Bloom
filter. Pass 2 tests each row: a row that the filter does not hold has no copy and passes
straight through. Only the other rows shuffle, and are grouped by their SHA-256.

The filter has two hash functions and ``CELLS_PER_HASH`` cells per repeated hash, so the share
of rows it flags in vain (about one in sixty) does not grow with the number of rows. It is
stored as words of 64 cells, without empty words, and broadcast. A filter of more than
``MAX_CELLS`` cells is split by a prefix of the hash: the rows are then stored once, dealt by
that prefix, and each part is tested against its own part of the filter, so that no more than
``MAX_CELLS`` cells are ever sent to a task.

Texts are equal when identical after lower-casing A-Z; null counts as the empty text, and
empty texts are equal to each other. Of equal texts the row with the largest id stays; a null
id is smaller than any other. Of rows equal in text and id exactly one stays. An empty table
gives an empty result. Other columns take no part, whatever their names; :func:`drop_copies`
returns them unchanged. Long texts are hashed whole, in constant memory beyond the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixmill.llm.common import ascii_lower, fresh_name
from matrixmill.sources.tables import checkpointed, staged

#: Cells of the filter per repeated hash, and the most that one part of it may have.
CELLS_PER_HASH = 16
MAX_CELLS = 1 << 27
_WORD = 64
_SECOND_SEED = 11
_PART_SEED = 23


def _normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def _cells(hash_column: Column, cells: int) -> list[Column]:
    """The two cells of a hash, each within its own half of the filter."""
    half = cells // 2
    return [F.pmod(hash_column, F.lit(half)), F.pmod(F.xxhash64(hash_column, F.lit(_SECOND_SEED)), F.lit(half)) + half]


def _part(hash_column: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(hash_column, F.lit(_PART_SEED)), F.lit(parts)).cast("int")


def filter_size(hashes: int) -> tuple[int, int]:
    """Parts of the filter, and cells of each: a power of two within the bound."""
    cells = min(MAX_CELLS, 1 << max(10, (hashes * CELLS_PER_HASH - 1).bit_length()))
    return max(1, -(-hashes * CELLS_PER_HASH // cells)), cells


def repeated_hashes(keys: DataFrame, key: str) -> DataFrame:
    """Pass 1: the 64-bit hashes of keys that two or more rows have."""
    counted = keys.select(F.xxhash64(key).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("rows"))
    return checkpointed(counted.filter("rows > 1").select("hash"))


def filter_words(hashes: DataFrame, parts: int, cells: int) -> DataFrame:
    """The filter as ``(part, word, bits)``: words of 64 cells, without empty ones."""
    cell = F.explode(F.array(*_cells(F.col("hash"), cells))).alias("cell")
    return checkpointed(
        hashes.select(_part(F.col("hash"), parts).alias("part"), cell)
        .groupBy("part", F.expr(f"cell div {_WORD}").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(cell % {_WORD} AS int))")).alias("bits"))
    )


def _tested(df: DataFrame, key: str, flag: str, words: DataFrame, cells: int) -> DataFrame:
    """Adds ``flag``: whether the filter ``(word, bits)``, which is broadcast, holds the key.

    A word exists at most once, so no row is repeated.
    """
    tested, hits = df, []
    for number, cell in enumerate(_cells(F.xxhash64(key), cells)):
        names = [fresh_name(tested, f"{part}_{number}") for part in ("cell", "word", "bits")]
        lookup = words.select(F.col("word").alias(names[1]), F.col("bits").alias(names[2]))
        tested = tested.withColumn(names[0], cell).join(
            F.broadcast(lookup), F.expr(f"{names[0]} div {_WORD} = {names[1]}"), "left"
        )
        hits.append(
            F.expr(f"coalesce(shiftright({names[2]}, CAST({names[0]} % {_WORD} AS int)) & 1, 0) = 1")
        )
    return tested.select(*[F.col(f"`{name}`") for name in df.columns], (hits[0] & hits[1]).alias(flag))


def flag_possible_copies(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Adds ``flag``, false only for rows whose key, a string column, occurs once.

    While the filter has one part the rows do not move. With several parts the rows are
    stored by part, where they are, and every part is read once.
    """
    hashes = repeated_hashes(df, key)
    parts, cells = filter_size(hashes.count())
    words = filter_words(hashes, parts, cells)
    if parts == 1:
        return _tested(df, key, flag, words, cells)
    part = fresh_name(df, "part")
    stored = staged(df.withColumn(part, _part(F.xxhash64(key), parts)), "parts", part)
    tested = [
        _tested(
            stored.filter(F.col(part) == number).select(*[f"`{name}`" for name in df.columns]),
            key,
            flag,
            words.filter(F.col("part") == number),
            cells,
        )
        for number in range(parts)
    ]
    return reduce(DataFrame.unionAll, tested)


def mark_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep_id`` is the id of the row that stays, ``text_sha256`` the hash of the normalised
    text. Texts are read and hashed once; all later passes read ids and hashes only.
    """
    keyed = staged(
        docs.select(
            F.col(id_column).alias("id"), F.sha2(_normalised(F.col(text_column)), 256).alias("sha")
        ),
        "hashes",
    )
    flagged = flag_possible_copies(keyed, "sha", "possible")
    alone = flagged.filter("NOT possible").select(
        "id",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "sha",
    )
    rows = checkpointed(
        flagged.filter("possible").select("id", "sha", F.monotonically_increasing_id().alias("row"))
    )
    # Stored, so that the join back shuffles both sides and a hot text's rows can be split.
    groups = checkpointed(
        rows.groupBy("sha").agg(
            F.max(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")
        )
    )
    grouped = rows.join(groups, "sha").select(
        "id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"),
        "sha",
    )
    return alone.unionByName(grouped).withColumnsRenamed({"id": id_column, "sha": "text_sha256"})


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.

    Rows without a copy do not move. The others are reduced to one per text by an
    aggregation that starts before the shuffle, so a text with a third of all rows reaches
    it as one row per task.
    """
    sha, flag = fresh_name(docs, "sha"), fresh_name(docs, "possible")
    keyed = docs.withColumn(sha, F.sha2(_normalised(F.col(text_column)), 256))
    flagged = flag_possible_copies(keyed, sha, flag)
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    winners = (
        flagged.filter(F.col(flag))
        .groupBy(sha)
        .agg(F.max_by(whole, F.struct(F.col(id_column))).alias("best"))
        .select("best.*")
    )
    return flagged.filter(~F.col(flag)).select(*[f"`{name}`" for name in docs.columns]).unionByName(winners)
