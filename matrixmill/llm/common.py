"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bytes of one item's UTF-8 text per Arrow batch handed to a Python function at once.
SLICE_BYTES = 8 * 1024 * 1024


def read_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front until no column of ``df`` has that name."""
    taken = {name.lower() for name in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def other_columns(df: DataFrame, *names: str) -> list[int]:
    """Places of the columns with none of these names, whatever their case."""
    taken = {name.lower() for name in names}
    return [at for at, name in enumerate(df.columns) if name.lower() not in taken]


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other character; null stays null.

    ``lower`` does the same and is much faster where a text has one byte per character.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Applies ``function`` to Arrow batches of about :data:`SLICE_BYTES`.

    Batches are sliced by their size, so neither many long texts nor many columns make one
    call large; a single row is never cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, int(batch.num_rows * SLICE_BYTES / max(batch.nbytes, SLICE_BYTES)))
            for start in range(0, batch.num_rows, rows):
                yield from function(batch.slice(start, rows))

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> Iterator[str]:
    """The strings of a column one by one, null as the empty text."""
    for value in column:
        yield value.as_py() or ""


def utf8_of(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a column one by one, null as no bytes."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; a run of length 0 gives 0."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


class _Numbers(dict):
    """Numbers in order of appearance; looking up a new token adds it."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, token: str) -> int:
        self.new.append(token)
        number = self[token] = len(self)
        return number


class TokenTable:
    """Values that ``describe`` gives for tokens, computed once per token and remembered.

    Everything is forgotten once ``limit`` tokens are held, or tokens of ``letters`` characters
    in all, so memory stays bounded however long a task runs and however long its tokens are.
    """

    def __init__(
        self,
        describe: Callable[[str], tuple],
        dtypes: tuple,
        limit: int = 400_000,
        letters: int = 16 * 1024 * 1024,
    ):
        self._describe, self._dtypes, self._limit, self._letters = describe, dtypes, limit, letters
        self._forget()

    def _forget(self) -> None:
        self._numbers = _Numbers()
        self._held = 0
        # Grown by doubling, so that adding tokens costs no copy of all known ones.
        self._columns = [np.zeros(1024, kind) for kind in self._dtypes]

    def values(self, tokens: list[str]) -> list[np.ndarray]:
        """One array per described value, with an entry per token."""
        if len(self._numbers) > self._limit or self._held > self._letters:
            self._forget()
        numbers = self._numbers
        known = len(numbers)
        at = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
        if numbers.new:
            self._held += sum(map(len, numbers.new))
            rows = zip(*map(self._describe, numbers.new), strict=True)
            numbers.new = []
            for place, values in enumerate(rows):
                column = self._columns[place]
                if len(numbers) > len(column):
                    column = np.concatenate((column, np.zeros(max(len(column), len(numbers)), column.dtype)))
                    self._columns[place] = column
                column[known : len(numbers)] = values
        return [column[at] for column in self._columns]
