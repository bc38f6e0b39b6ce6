"""SimHash near-duplicates, with candidates found by pigeonring filtering.

A fingerprint's 64 bits are cut into five consecutive segments on a ring. If two fingerprints
differ in at most 4 bits, there is a segment from which on every chain of ``l`` consecutive
segments differs in at most ``4 * l / 5`` bits: 0, 1, 2, 3, 4. So for each start the first
segment must be equal and the second may differ in one bit. That is a join key of about 26
bits: a fingerprint is filed under its own two segments, and under those with one set bit of
the second segment cleared. Two fingerprints one bit apart there meet under the one with the
bit cleared. Longer chains are checked before the full distance.

Equal fingerprints are merged first, so exact copies cost nothing. Within a key, fingerprints
are linked by a spanning forest, never by all pairs; a key with very many fingerprints is cut
into blocks and each pair of blocks compared on its own, so no task holds the whole key.

Words are what ``[^\\x20\\x09-\\x0D]+`` matches after lower-casing A-Z. Texts with fewer than
``SHINGLE`` words have one shingle, texts without words (null, empty) fingerprint zero, linked
like any other. Ids may repeat or be null: equal texts share a component, whose id is its
smallest id, and null only if it has no other. An empty table gives an empty result. Other
columns take no part, whatever their names; :func:`drop_near_duplicates` keeps them. A long text
is held whole by one task with the hashes of one portion of its shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixmill.llm.common import fresh_name, map_batches, other_columns, utf8_of
from matrixmill.llm.components import connected_components
from matrixmill.plans.joins import lookup_join
from matrixmill.sources.tables import checkpointed, staged

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42

#: Fingerprints of one key that are compared at once; a larger key is cut into blocks.
BLOCK = 4096
#: Groups up to this size are compared along diagonals, many groups at a time.
SMALL_GROUP = 16

# Bits of a byte by value, to turn counts of byte values into counts of set bits.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_BYTE_BASE = (np.arange(8) * 256)[None, :]
_CHUNK = 1 << 16


def text_fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text; works through long texts in chunks of shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    span = min(shingle, len(words))
    starts = np.concatenate(([0], gaps + 1))[: len(words) - span + 1]
    ends = np.concatenate((gaps, [len(joined)]))[span - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(2048, np.int64)
    for at in range(0, len(starts), _CHUNK):
        pairs = zip(starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
        codes = hashes.view(np.uint8).reshape(-1, 8) + _BYTE_BASE
        counts += np.bincount(codes.ravel(), minlength=2048)
    ones = counts.reshape(8, 256) @ _BYTE_BITS.astype(np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def add_fingerprints(
    docs: DataFrame, text_column: str, output: str = "fingerprint", shingle: int = SHINGLE
) -> DataFrame:
    """``docs`` with the fingerprint as a signed long; a column of that name is replaced."""

    at = docs.columns.index(text_column)
    kept = other_columns(docs, output)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = utf8_of(batch.column(at))
        values = np.array([text_fingerprint(text, shingle) for text in texts], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in kept], pa.array(values.view(np.int64))],
            names=[*[batch.schema.names[i] for i in kept], output],
        )

    schema = docs.select(*[F.col(f"`{docs.columns[i]}`") for i in kept]).withColumn(output, F.lit(0).cast("long")).schema
    return map_batches(docs, run, schema)


def _ring(distance: int) -> tuple[list[int], list[int], list[list[int]]]:
    """Offsets and widths of the segments, and for each start the masks of its chains."""
    number = distance + 1
    widths = [64 // number + (i < 64 % number) for i in range(number)]
    offsets = [sum(widths[:i]) for i in range(number)]
    segment = [((1 << widths[i]) - 1) << offsets[i] for i in range(number)]
    chains = [
        [sum(segment[(i + k) % number] for k in range(length)) for length in range(1, number + 1)]
        for i in range(number)
    ]
    return offsets, widths, chains


def _keys(distance: int):
    """Function that files fingerprints under their keys, as ``(start, key, fp)`` rows."""
    offsets, widths, _ = _ring(distance)
    number = len(widths)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for start in range(number):
            after = (start + 1) % number
            first = (fps >> np.uint64(offsets[start])) & np.uint64((1 << widths[start]) - 1)
            second = (fps >> np.uint64(offsets[after])) & np.uint64((1 << widths[after]) - 1)
            own = (first << np.uint64(widths[after])) | second
            keys, values = [own], [fps]
            for bit in range(widths[after]):
                has = (second >> np.uint64(bit)) & np.uint64(1) == 1
                keys.append(own[has] ^ np.uint64(1 << bit))
                values.append(fps[has])
            key, value = np.concatenate(keys), np.concatenate(values)
            # The start goes into the lowest bits, so that one number names the key.
            yield pa.RecordBatch.from_arrays(
                [pa.array((key * np.uint64(number) + np.uint64(start)).view(np.int64)), pa.array(value.view(np.int64))],
                names=["key", "fp"],
            )

    return run


def _linked(xor: np.ndarray, masks: list, distance: int) -> np.ndarray:
    """Which differences stay within the budget of every chain, and of the whole ring."""
    within = np.ones(len(xor), bool)
    for length, mask in enumerate(masks, 1):
        here = mask[within] if np.ndim(mask) else mask
        within[within] = np.bitwise_count(xor[within] & here) <= distance * length // len(masks)
    return within


def _changes(groups: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether another group or key begins after each row but the last."""
    return (groups[1:] != groups[:-1]) | (keys[1:] != keys[:-1])


def _forest(fps: np.ndarray, masks: list[np.uint64], distance: int) -> tuple[list, list]:
    """Edges of a spanning forest of one group, found by search from node to node."""
    left, right = [], []
    rest = fps
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            xor = rest ^ node
            near = _linked(xor, masks, distance)
            found = rest[near]
            left += [node] * len(found)
            right += found.tolist()
            queue += list(found)
            rest = rest[~near]
    return left, right


def _compare(distance: int):
    """Function over rows sorted by group that yields links within each group."""
    _, _, chains = _ring(distance)
    number = len(chains)
    table = [np.array([chains[start][k] for start in range(number)], np.uint64) for k in range(number)]

    def links(groups: np.ndarray, keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], _changes(groups, keys))))
        sizes = np.diff(np.concatenate((starts, [len(groups)])))
        left, right = [], []
        size_of = np.repeat(sizes, sizes)
        small = np.flatnonzero((size_of > 1) & (size_of <= SMALL_GROUP))
        g, k, f = groups[small], keys[small], fps[small]
        for gap in range(1, int(sizes[(sizes > 1) & (sizes <= SMALL_GROUP)].max(initial=1))):
            same = np.flatnonzero((g[gap:] == g[:-gap]) & (k[gap:] == k[:-gap]))
            if not len(same):
                break
            xor = f[same] ^ f[same + gap]
            start = (k[same] % number).astype(np.int64)
            near = same[_linked(xor, [m[start] for m in table], distance)]
            left.append(f[near])
            right.append(f[near + gap])
        for at, size in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP], strict=True):
            start = int(keys[at] % number)
            a, b = _forest(np.unique(fps[at : at + size]), [m[start] for m in table], distance)
            left.append(np.array(a, np.uint64))
            right.append(np.array(b, np.uint64))
        a = np.concatenate([np.zeros(0, np.uint64), *left])
        b = np.concatenate([np.zeros(0, np.uint64), *right])
        differ = a != b
        return pa.RecordBatch.from_arrays(
            [pa.array(a[differ].view(np.int64)), pa.array(b[differ].view(np.int64))], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)]
        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
            kept = [np.concatenate(pair) for pair in zip(kept, new, strict=True)]
            ends = np.flatnonzero(_changes(kept[0], kept[1]))
            if len(ends):  # the last group may go on in the next batch
                done = ends[-1] + 1
                yield links(*[part[:done] for part in kept])
                kept = [part[done:] for part in kept]
        if len(kept[0]):
            yield links(*kept)

    return run


def fingerprint_links(fingerprints: DataFrame, distance: int = MAX_DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that span every component.

    ``fingerprints`` has one column of distinct longs. Every pair within ``distance`` bits
    ends in one component; ``distance`` may be 1 to 7.
    """
    filed = map_batches(fingerprints, _keys(distance), "key long, fp long")
    hot = checkpointed(
        filed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > block)
        .select("key", F.ceil(F.col("members") / block).cast("int").alias("blocks"))
    )
    if hot.isEmpty():
        grouped = filed.select(F.lit(0).cast("long").alias("grp"), "key", "fp")
    else:
        # A fingerprint of block b goes to every pair of blocks that b is part of.
        own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        cut = (
            filed.join(hot, "key", "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .select("key", "fp", own.alias("own"), partner.alias("partner"))
        )
        grouped = cut.select(
            F.xxhash64("key", F.least("own", "partner"), F.greatest("own", "partner")).alias("grp"), "key", "fp"
        )
    spread = grouped.repartition("grp", "key").sortWithinPartitions("grp", "key")
    return spread.mapInArrow(_compare(distance), "a long, b long").distinct()


def components(fingerprinted: DataFrame, id_column: str, fp: str, distance: int = MAX_DISTANCE) -> DataFrame:
    """``(fp, component_id, members)`` for each distinct fingerprint.

    ``members`` is the number of rows in the whole component, ``component_id`` its least id.
    """
    distinct = checkpointed(
        fingerprinted.groupBy(F.col(fp).alias("fp")).agg(
            F.min(id_column).alias("least_id"), F.count(F.lit(1)).alias("rows")
        )
    )
    roots = connected_components(fingerprint_links(distinct.select("fp"), distance), "a", "b")
    rooted = checkpointed(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    )
    # Stored before it is joined back: then a large component's rows can be spread.
    whole = checkpointed(
        rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.sum("rows").alias("members"))
    )
    return lookup_join(rooted.select("fp", "root"), whole, "root").select("fp", "root", "component_id", "members")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_size`` is the number of rows in the component.
    """
    pairs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = staged(add_fingerprints(pairs, "text", "fp", shingle).select("id", "fp"), "fingerprints")
    groups = components(rows, "id", "fp", distance)
    return rows.join(groups, "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("members").alias("component_size"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """The row of each component with the least id; null ids come last, columns unchanged.

    Rows that are alone in their component are not grouped. The others are reduced by an
    aggregation that starts before the shuffle, so a large component is no large group.
    """
    fp, root = fresh_name(docs, "fp"), fresh_name(docs, "root")
    rows = staged(add_fingerprints(docs, text_column, fp, shingle), "fingerprinted")
    crowded = components(rows, id_column, fp, distance).filter("members > 1").select(
        F.col("fp").alias(fp), F.col("root").alias(root)
    )
    marked = rows.join(checkpointed(crowded), fp, "left")
    names = [F.col(f"`{name}`") for name in docs.columns]
    order = F.struct(F.col(id_column).isNull(), F.col(id_column))
    firsts = (
        marked.filter(F.col(root).isNotNull())
        .groupBy(root)
        .agg(F.min_by(F.struct(*names), order).alias("first"))
        .select("first.*")
    )
    return marked.filter(F.col(root).isNull()).select(*names).unionByName(firsts)
