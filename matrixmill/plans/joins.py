"""Joining a large fact table to a lookup whose size is measured first."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from matrixmill.functions.names import quoted
from matrixmill.sources.tables import is_stored, staged

#: Largest lookup, in bytes of its values, that is sent to every executor. The lookups
#: here hold strings and numbers; other types have no bounded width and are not measured.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Share of the fact rows, as one in so many, above which a key counts as hot. A hot key is
#: cut into pieces of about that share, so there are fewer hot keys, and fewer than twice as
#: many pieces in all, than this number, whatever the size of the tables.
PIECES = 500

_VALUE_OVERHEAD = 16
_SALT = "_salt"
_PIECES = "_pieces"
_PLACE = "_place"


def measured_bytes(df: DataFrame) -> int:
    """Size of all values of ``df``, by one aggregate that returns a single number."""
    widths = [
        f"coalesce(octet_length({quoted(field.name)}), 0)"
        for field in df.schema
        if isinstance(field.dataType, StringType)
    ]
    row = " + ".join([str(_VALUE_OVERHEAD * len(df.columns)), *widths])
    return df.selectExpr(f"coalesce(sum(CAST({row} AS bigint)), 0) AS bytes").first()["bytes"]


def hot_keys(facts: DataFrame, key: str, pieces: int = PIECES) -> dict:
    """The keys that hold more than one in ``pieces`` of the rows, with the number of such shares.

    One pass: the counts start as partial aggregates, and each task passes on its ``pieces``
    largest ones, which are at least as many as there can be hot keys.
    """
    seen = Observation()
    counts = (
        facts.select(F.col(quoted(key)).alias("key"))
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .filter("key IS NOT NULL")
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    largest = counts.orderBy(F.desc("rows")).limit(pieces).collect()
    if not largest:
        return {}
    total = seen.get["rows"]
    return {
        row["key"]: math.ceil(row["rows"] * pieces / total)
        for row in largest
        if row["rows"] * pieces > total
    }


def _place(facts: DataFrame) -> Column:
    """A number for each row: a repeated task deals its rows as before, and equal rows of
    different tasks get different numbers."""
    return F.xxhash64(*[F.col(quoted(name)) for name in facts.columns], F.spark_partition_id())


def _salted_join(facts: DataFrame, lookup: DataFrame, key: str, how: str, hot: dict) -> DataFrame:
    """The join with each hot key cut into pieces; rows of other keys are joined as they are."""
    kind = facts.schema[key].dataType.simpleString()
    pieces = F.broadcast(
        facts.sparkSession.createDataFrame(list(hot.items()), f"{quoted(key)} {kind}, {_PIECES} int")
    )
    salted = facts.withColumn(_PLACE, _place(facts)).join(pieces, key, "left")
    salted = salted.withColumn(
        _SALT, F.pmod(_PLACE, F.coalesce(_PIECES, F.lit(1))).cast("int")
    ).drop(_PLACE, _PIECES)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(_PIECES, F.lit(1)) - 1))
    repeated = lookup.join(pieces, key, "left").withColumn(_SALT, copies).drop(_PIECES)
    return salted.join(repeated, [key, _SALT], how).drop(_SALT)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    lookup_bytes: int | None = None,
) -> DataFrame:
    """Equi-join of ``facts`` with ``lookup``; ``key`` comes first in the result.

    A lookup within ``broadcast_bytes`` is broadcast and the fact table does not move.
    Its size is measured here, unless the caller has measured it as ``lookup_bytes``. A
    lookup that is not stored is written once to the shared folder, so measuring does not
    compute it a second time.

    A larger one is joined by a shuffle. The rows per key are counted first: only keys above
    one in ``PIECES`` of the fact rows are salted, each into as many pieces as it holds such
    shares, and only their lookup rows are repeated. Without such keys nothing is salted. No
    row is left out. ``facts`` is then read twice.
    """
    if lookup_bytes is None:
        lookup = lookup if is_stored(lookup) else staged(lookup, "lookup")
        lookup_bytes = measured_bytes(lookup)
    if lookup_bytes <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), key, how)
    hot = hot_keys(facts, key)
    if not hot:
        return facts.join(lookup, key, how)
    return _salted_join(facts, lookup, key, how, hot)
