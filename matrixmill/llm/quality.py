"""Document quality by histogram gradient-boosted trees over document statistics.

Statistics of each text (shares of kinds of characters, repetition of words and lines,
lengths, entropies) are cut into at most ``BINS`` bins; trees of fixed depth are grown on
sums of gradients per bin. All trees are flattened into arrays of complete binary trees, and
a batch of texts walks down all of them at once in numpy.

Fitting uses at most ``MAX_ROWS`` labelled documents, chosen by the hash of their id; of those
only the statistics reach the driver. Several labels of one document count as good if one
is. Without labels every score is 0.5. Other columns are kept; one with the name of an output is
replaced by it. The statistics of a text without words (null, empty)
are 0; it is scored like any other. Repeated rows and ids are each scored; an empty table
gives an empty result. Whole texts are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixmill.llm.common import map_batches, other_columns, texts_of
from matrixmill.sources.tables import checkpointed

MAX_ROWS = 20_000
BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.15
PENALTY = 1.0
MIN_WEIGHT = 5.0

#: Labels to learn from; the others are held out.
TRAINING = "pmod(crc32(CAST(CAST(doc_id AS string) AS binary)), 5) <> 0"
ACCEPTED = 0.3

STATISTICS = (
    "log_chars", "log_words", "word_length", "upper", "digits", "spaces", "punctuation", "symbols", "bars",
    "exclamations", "non_ascii", "byte_entropy", "distinct_words", "top_word", "next_equal", "word_entropy",
    "symbol_words", "upper_words", "log_lines", "line_length", "equal_lines", "stops", "end_symbols",
)

_KINDS = np.zeros((256, 8))
for _code in range(256):
    _c = chr(_code)
    _KINDS[_code] = [
        "A" <= _c <= "Z", "0" <= _c <= "9", _c in " \t\n\r", _c in ".,;:'\"()-", _code < 128 and _c.isprintable()
        and not _c.isalnum() and _c not in " .,;:'\"()-!|", _c == "|", _c == "!", _code >= 128,
    ]


def _entropy(counts: np.ndarray) -> float:
    shares = counts[counts > 0] / max(counts.sum(), 1)
    return float(-(shares * np.log2(shares)).sum())


def statistics(text: str) -> list[float]:
    """The statistics of one text, in the order of :data:`STATISTICS`."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    size, number = len(text), len(words)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    kinds = (counts @ _KINDS) / size
    tally = Counter(words)
    lines = text.split("\n")
    return [
        np.log1p(size),
        np.log1p(number),
        (size - number + 1) / number,
        *kinds.tolist(),
        _entropy(counts),
        len(tally) / number,
        max(tally.values()) / number,
        sum(map(eq, words, words[1:])) / number,
        _entropy(np.fromiter(tally.values(), np.int64)) / np.log2(number + 1),
        sum(count for word, count in tally.items() if not word[0].isalnum()) / number,
        sum(count for word, count in tally.items() if word.isupper()) / number,
        np.log1p(len(lines)),
        np.log1p(size / len(lines)),
        1 - len(set(lines)) / len(lines),
        sum(count for word, count in tally.items() if word[-1] in ".!?") / number,
        sum(count for word, count in tally.items() if not word[-1].isalnum() and word[-1] not in ".,;:!?\"')") / number,
    ]


class Forest(NamedTuple):
    """All trees as arrays: per tree the inner nodes of a complete tree, and its leaves."""

    base: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        rows = np.arange(len(values))
        total = np.full(len(values), self.base)
        inner = self.cuts.shape[1] if self.cuts.ndim == 2 else 0
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(values), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (values[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return 1.0 / (1.0 + np.exp(-total))


def grow_forest(values: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Gradient boosting of the logistic loss on binned statistics."""
    share = np.clip(labels.mean(), 0.01, 0.99) if len(labels) else 0.5
    base, inner = float(np.log(share / (1 - share))), 2**depth - 1
    empty = Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not len(labels) or labels.min() == labels.max():
        return empty
    width = values.shape[1]
    edges = [np.unique(np.quantile(values[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], values[:, j], "left") for j in range(width)], 1)
    codes = binned + np.arange(width) * BINS
    total = np.full(len(labels), base)
    grown: list[tuple] = []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, weight = labels - chance, chance * (1 - chance)
        features, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(labels), np.int64)
        for level in range(depth):
            first, number = 2**level - 1, 2**level
            at = (((node - first) * width * BINS)[:, None] + codes).ravel()
            shape = (number, width, BINS)
            g = np.bincount(at, np.repeat(slope, width), number * width * BINS).reshape(shape).cumsum(2)
            h = np.bincount(at, np.repeat(weight, width), number * width * BINS).reshape(shape).cumsum(2)
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + PENALTY) + (all_g - g) ** 2 / (all_h - h + PENALTY) - all_g**2 / (all_h + PENALTY)
            gain[(h < MIN_WEIGHT) | (all_h - h < MIN_WEIGHT)] = 0
            best = gain.reshape(number, -1).argmax(1)
            for k, code in enumerate(best):
                j, cut = divmod(int(code), BINS)
                if gain[k, j, cut] > 1e-9 and cut < len(edges[j]):
                    features[first + k], cuts[first + k] = j, edges[j][cut]
            node = 2 * node + 1 + (values[np.arange(len(labels)), features[node]] > cuts[node])
        leaf_g = np.bincount(node - inner, slope, inner + 1)
        leaf_h = np.bincount(node - inner, weight, inner + 1)
        leaves = RATE * leaf_g / (leaf_h + PENALTY)
        total += leaves[node - inner]
        grown.append((features, cuts, leaves))
    return Forest(base, *[np.stack(x) for x in zip(*grown, strict=True)])


def add_statistics(docs: DataFrame, text_column: str = "text", output: str = "statistics") -> DataFrame:
    """``docs`` without the text, with the array of its statistics."""
    return _with_values(docs, text_column, output, "array<double>", lambda rows: pa.array(list(rows), pa.list_(pa.float64())))


def _with_values(docs: DataFrame, text_column: str, output: str, kind: str, of) -> DataFrame:
    at = docs.columns.index(text_column)
    kept = other_columns(docs, text_column, output)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = np.array([statistics(text) for text in texts_of(batch.column(at))])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in kept], of(values)], names=[*[batch.schema.names[i] for i in kept], output]
        )

    schema = docs.select(*[F.col(f"`{docs.columns[i]}`") for i in kept]).withColumn(output, F.lit(None).cast(kind)).schema
    return map_batches(docs, run, schema)


def fit_model(docs: DataFrame, labels: DataFrame, usable: str = "true") -> Forest:
    """Fits the trees on labelled documents for whose ``labels`` row the SQL ``usable`` holds."""
    single = labels.filter(usable).filter("quality IS NOT NULL AND doc_id IS NOT NULL")
    chosen = (
        single.groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_ROWS)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(checkpointed(chosen)), "doc_id")
    # One row per id, so that repeated documents don't grow what is collected.
    rows = add_statistics(texts).groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.min("statistics").alias("statistics")
    ).collect()
    rows.sort(key=lambda row: row["doc_id"])
    values = np.array([row["statistics"] for row in rows]).reshape(len(rows), len(STATISTICS))
    return grow_forest(values, np.array([float(row["quality"]) for row in rows]))


def score(docs: DataFrame, forest: Forest, text_column: str = "text", output: str = "score") -> DataFrame:
    """``docs`` without the text, with the probability that it is of good quality."""
    return _with_values(docs, text_column, output, "double", lambda values: pa.array(forest.scores(values)))
