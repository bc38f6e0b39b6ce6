"""Toxicity by a linear-chain conditional random field over the words of a text.

Token labels come from document labels. A word form, or the beginning of one, marks toxic
words if it occurs in toxic documents in many different surroundings and in others hardly at
all; surroundings (the words before and after) are counted rather than documents, so copies of
a document count once. Words of toxic documents that carry a mark are labelled 1, all other
words 0, and the field is fitted on these chains. It weighs forms and beginnings of words it
knows against each other and against the labels next to them.

A chain is a sentence: it ends with a word that ends in ``.``, ``!`` or ``?``. The score of a
text is the largest marginal probability of label 1 of its words, from forward and backward
messages over whole chains; words of 0.5 or more form the offending spans, given as code
points with the end exclusive.

Fitting uses at most ``MAX_TOXIC`` toxic and ``MAX_OTHER`` other labelled documents, at most
``MAX_CHAINS`` chains, both chosen by hash, the ``MAX_MARKS`` marks of most evidence, and cuts
training chains every ``CHAIN_WORDS`` words, so that what the driver fits is bounded. Scoring
bounds nothing: it takes whole texts and whole chains. Several labels of one document count as toxic if one
is. Without toxic labels every score is 0. Texts without words, null among them, score 0.
Repeated rows and ids are each scored; an empty table gives an empty result. Other columns are
kept; one with the name of an output is replaced by it. A long text is held whole by one task,
with some numbers for each of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixmill.llm import crf
from matrixmill.llm.common import TokenTable, fresh_name, map_batches, other_columns, texts_of
from matrixmill.sources.tables import checkpointed

MAX_TOXIC = 4_000
MAX_OTHER = 8_000
MAX_CHAINS = 20_000
CHAIN_WORDS = 200

#: Beginnings of words that count as a feature, by length.
STEMS = (4, 5, 6)
#: Least log-likelihood ratio, share of toxic surroundings and count of them for a mark.
MIN_EVIDENCE = 40.0
MIN_SHARE = 0.9
MIN_SURROUNDINGS = 8
MAX_MARKS = 20_000
#: Share of a beginning's surroundings from which on a longer mark replaces it.
NARROWER = 0.95

#: Labels to learn from; the others are held out.
TRAINING = "pmod(crc32(CAST(CAST(doc_id AS string) AS binary)), 3) <> 1"

TAGGED = 0.5
REJECTED = 0.7

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’„…–—¿¡"
_WORD = re.compile(r"\S+")


class ToxicityModel(NamedTuple):
    """Weight of each known feature, of every word, and of neighbouring labels."""

    weights: dict[str, float]
    bias: float
    transitions: crf.Transitions


def _features(word: str) -> list[str]:
    """Names of a stripped lower-case word's features."""
    return [f"={word}", *[f"{n}{word[:n]}" for n in STEMS if len(word) >= n]] if word else []


def _strip(token: str) -> str:
    return token.strip(_EDGES).lower()


def _ends_chain(token: str) -> bool:
    return token[-1] in ".!?"


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: str) -> DataFrame:
    """``(text, toxic)`` of the labelled documents to learn from, at most the stated numbers.

    The ids are chosen first, in the label table alone, by the order of their hashes.
    """
    single = labels.filter(usable).filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
    single = single.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    parts = [
        single.filter(F.col("toxic") == label).orderBy(order, "doc_id").limit(most)
        for label, most in ((1, MAX_TOXIC), (0, MAX_OTHER))
    ]
    chosen = checkpointed(parts[0].unionByName(parts[1]))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    return checkpointed(texts.filter("text IS NOT NULL").distinct())


def _marks(sample: DataFrame) -> DataFrame:
    """``(feature)`` of word forms and beginnings that mark toxic words."""
    raw = F.filter(F.split(F.col("text"), r"\s+"), lambda word: word != "")
    words = F.transform(raw, lambda word: F.lower(F.btrim(word, F.lit(_EDGES))))
    places = sample.select("toxic", words.alias("words")).select(
        "toxic", "words", F.posexplode("words").alias("at", "word")
    )
    around = F.xxhash64(F.get("words", F.col("at") - 1), "word", F.get("words", F.col("at") + 1))
    seen = places.filter("word <> ''").select("toxic", "word", around.alias("around")).distinct()
    counts = seen.groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("ones"), F.count_if(F.col("toxic") == 0).alias("zeros")
    )
    counts = checkpointed(counts)
    all_ones, all_zeros = counts.agg(F.sum("ones"), F.sum("zeros")).first()
    base = (all_ones or 0) / max((all_ones or 0) + (all_zeros or 0), 1)
    names = F.array(
        F.concat(F.lit("="), "word"),
        *[F.when(F.char_length("word") >= n, F.concat(F.lit(str(n)), F.substring("word", 1, n))) for n in STEMS],
    )
    by_feature = (
        counts.select(F.explode(F.array_compact(names)).alias("feature"), "ones", "zeros")
        .groupBy("feature")
        .agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
        .filter(F.col("ones") >= MIN_SURROUNDINGS)
    )
    share = F.col("ones") / (F.col("ones") + F.col("zeros"))
    part = F.when(F.col("zeros") > 0, F.col("zeros") * F.log((1 - share) / (1 - F.lit(base)))).otherwise(0.0)
    evidence = 2 * (F.col("ones") * F.log(share / F.lit(base)) + part)
    return (
        by_feature.filter((share >= MIN_SHARE) & (evidence >= MIN_EVIDENCE))
        .orderBy(evidence.desc(), "feature")
        .limit(MAX_MARKS)
        .select("feature", "ones")
    )


def _narrowest(marks: dict[str, int]) -> frozenset[str]:
    """Marks without the beginnings whose surroundings are almost all those of a longer mark.

    Such a beginning says no more than the longer one, but would also fit other words.
    """
    within: dict[str, int] = {}
    for feature, ones in marks.items():
        word = feature[1:]
        for n in STEMS:
            if n < len(word) or (n == len(word) and feature[0] == "="):
                stem = f"{n}{word[:n]}"
                within[stem] = max(within.get(stem, 0), ones)
    return frozenset(f for f, ones in marks.items() if within.get(f, 0) < NARROWER * ones)


def _chains(sample: DataFrame, marks: frozenset) -> DataFrame:
    """Up to :data:`MAX_CHAINS` chains as ``(words, labels)``: half of them with a marked word."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, labels = [], []
        for text, toxic in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            chain: list[str] = []
            for token in text.split():
                chain.append(_strip(token))
                if _ends_chain(token) or len(chain) == CHAIN_WORDS:
                    words.append(chain)
                    labels.append(toxic)
                    chain = []
            if chain:
                words.append(chain)
                labels.append(toxic)
        tags = [
            [int(toxic and any(f in marks for f in _features(word))) for word in chain]
            for chain, toxic in zip(words, labels, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.list_(pa.string())), pa.array(tags, pa.list_(pa.int32()))], names=["words", "tags"]
        )

    chains = map_batches(sample, run, "words array<string>, tags array<int>").distinct()
    order = F.xxhash64("words")
    marked = F.array_contains("tags", 1)
    most = MAX_CHAINS // 2
    return (
        chains.filter(marked).orderBy(order).limit(most)
        .unionByName(chains.filter(~marked).orderBy(order).limit(most))
    )


def fit_model(docs: DataFrame, labels: DataFrame, usable: str = "true") -> ToxicityModel:
    """Fits the field on labelled documents for whose ``labels`` row the SQL ``usable`` holds.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic``.
    """
    sample = labelled_sample(docs, labels, usable)
    marks = _narrowest({row["feature"]: row["ones"] for row in _marks(sample).collect()})
    if not marks:
        return ToxicityModel({}, -50.0, crf.Transitions(0.0, 0.0, 0.0))
    rows = _chains(sample, marks).collect()
    rows.sort(key=lambda row: (row["words"], row["tags"]))
    names: dict[str, int] = {"": 0}
    tokens, features = [], []
    at = 0
    for row in rows:
        for word in row["words"]:
            # Known features only: others are in no other chain, or speak for neither label.
            for name in ("", *[f for f in _features(word) if f in marks]):
                tokens.append(at)
                features.append(names.setdefault(name, len(names)))
            at += 1
    labels_of = np.concatenate([np.array(row["tags"]) for row in rows])
    lengths = np.array([len(row["words"]) for row in rows])
    weights, transitions = crf.fit(np.array(tokens), np.array(features), len(names), labels_of, lengths)
    return ToxicityModel({n: float(weights[i]) for n, i in names.items() if n}, float(weights[0]), transitions)


def _describe(model: ToxicityModel):
    def run(token: str) -> tuple[float, bool]:
        score = model.bias + sum(model.weights.get(f, 0.0) for f in _features(_strip(token)))
        return score, _ends_chain(token)

    return run


def _spans(text: str, chosen: np.ndarray) -> list[dict[str, int]]:
    """Stretches of chosen words next to each other, without punctuation at their ends."""
    spans: list[dict[str, int]] = []
    last = -2
    for number, match in enumerate(_WORD.finditer(text)):
        if not chosen[number]:
            continue
        token = match.group()
        start = match.start() + len(token) - len(token.lstrip(_EDGES))
        end = match.end() - (len(token) - len(token.rstrip(_EDGES)))
        if last == number - 1:
            spans[-1]["end"] = end
        else:
            spans.append({"start": start, "end": end})
        last = number
    return spans


def tag(
    docs: DataFrame,
    model: ToxicityModel,
    text_column: str = "text",
    score: str = "score",
    spans: str = "spans",
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the toxicity score and the offending spans of each text."""
    at = docs.columns.index(text_column)
    kept = other_columns(docs, score, spans, *([] if keep_text else [text_column]))
    state: dict[str, TokenTable] = {}

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = state.setdefault("table", TokenTable(_describe(model), (np.float64, bool)))
        texts = list(texts_of(batch.column(at)))
        split = [text.split() for text in texts]
        counts = np.array([len(words) for words in split], np.int64)
        values, ends = table.values([word for words in split for word in words])
        last = np.cumsum(counts)[counts > 0] - 1
        ends[last] = True  # a text's last word ends its chain
        stops = np.flatnonzero(ends)
        chance = crf.marginals(values, np.diff(np.concatenate(([-1], stops))), model.transitions)
        scores, found = np.zeros(len(texts)), []
        begin = 0
        for row, count in enumerate(counts.tolist()):
            own = chance[begin : begin + count]
            begin += count
            scores[row] = own.max(initial=0.0)
            found.append(_spans(texts[row], own >= TAGGED) if scores[row] >= TAGGED else [])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in kept], pa.array(scores), pa.array(found, kind)],
            names=[*[batch.schema.names[i] for i in kept], score, spans],
        )

    schema = (
        docs.select(*[F.col(f"`{docs.columns[i]}`") for i in kept])
        .withColumn(score, F.lit(0.0))
        .withColumn(spans, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))))
        .schema
    )
    return map_batches(docs, run, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_column: str = "text", limit: float = REJECTED) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, columns unchanged."""
    score, spans = fresh_name(docs, "score"), fresh_name(docs, "spans")
    tagged = tag(docs, model, text_column, score, spans)
    return tagged.filter(F.col(score) < limit).drop(score, spans)
