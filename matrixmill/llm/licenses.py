"""Licence scan: a trained classifier of paragraphs, confirmed by comparison with templates.

A paragraph is a line of a text, or a statement wrapped over several: lines that follow each other,
all with words of templates, are judged together as well if one of them is licence-like without a
template, and count as one paragraph if together they have one. Its features are n-grams of one
to three words, not all short; a sparse multinomial logistic regression gives each licence family a probability, and one class
stands for paragraphs that are no licence statement. It is fitted on the templates, whole and
in changed and shortened forms amid words of the corpus, and on at most ``MAX_LINES`` lines of
the corpus, chosen by hash among those of at most ``LINE_CHARACTERS`` characters; the words that
statements are set amid are the first ``FILLER_WORDS`` of them. The probabilities are calibrated by a temperature fitted on forms
and lines that were held out. A prediction counts if the paragraph shares enough word n-grams
with a template of the family; a licence-like paragraph without such a template is reported
as ``unknown``.

Only n-grams of the templates have weights, so a paragraph without any has the unchanging
probabilities of an empty one and is passed over. Null and empty texts have no paragraphs;
repeated rows and ids are each scanned; an empty table gives an empty result. Whole texts are
read, a long one by one task; other columns take no part, whatever their names.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixmill.llm.common import TokenTable, map_batches, texts_of

# Wording that names a licence, by family.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    "lgpl": ("This library is licensed under the GNU Lesser General Public License, version 2.1.",),
    "agpl": ("This program is licensed under the GNU Affero General Public License, version 3.",),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "cc-by": ("Licensed under CC BY 4.0.", "Licensed under the Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.", "Licensed under the Creative Commons Attribution-ShareAlike 4.0 License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.", "Licensed under the Creative Commons Attribution-NonCommercial 4.0 License.",
    ),
    "public-domain": ("Released into the public domain under CC0 1.0.", "This work is dedicated to the public domain."),
    "proprietary": ("All rights reserved.", "Copyright by the author. All rights reserved."),
}
UNKNOWN = "unknown"

LONGEST_GRAM = 3
#: Letters of a word that makes an n-gram tell something; "of the" tells nothing.
TELLING = 5
FORMS_PER_TEMPLATE = 60
#: Characters of a line to learn from, and words that statements are set amid.
LINE_CHARACTERS = 1000
FILLER_WORDS = 20_000
_SPARE = 4
_HASHES = 1 << 40
MAX_LINES = 4_000
#: Least probability of being a licence statement, and least share of a template's n-grams.
LIKELY = 0.5
CONFIRMED = 0.6

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’„…–—"
_NONE = "none"


def words_of(paragraph: str) -> list[str]:
    stripped = (token.strip(_EDGES).lower() for token in paragraph.split())
    return [word for word in stripped if word]


def _grams(words: list[str]) -> list[str]:
    """Word n-grams with at least one word of :data:`TELLING` letters."""
    telling = [len(word) >= TELLING for word in words]
    return [
        " ".join(words[at : at + size])
        for size in range(1, LONGEST_GRAM + 1)
        for at in range(len(words) - size + 1)
        if any(telling[at : at + size])
    ]


def _pairs(words: list[str]) -> set[tuple[str, ...]]:
    """Words and neighbouring words, for comparison with a template."""
    return {(word,) for word in words} | set(zip(words, words[1:], strict=False))


class LicenceModel(NamedTuple):
    """Vocabulary of n-grams, weights by n-gram and class, and the temperature."""

    classes: tuple[str, ...]
    grams: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, words: list[str]) -> np.ndarray:
        known = [self.grams[g] for g in dict.fromkeys(_grams(words)) if g in self.grams]
        scores = (self.bias + self.weights[known].sum(0)) / self.temperature
        shares = np.exp(scores - scores.max())
        return shares / shares.sum()


def _changed_forms(words: list[str], filler: list[str], chance: random.Random) -> list[list[str]]:
    """Forms of a template with words lost, changed or added, alone or amid other words."""
    forms = [words]
    for number in range(FORMS_PER_TEMPLATE):
        form = [w for w in words if chance.random() > 0.05]
        if len(words) > 12 and number % 3 == 0:
            size = chance.randint(8, len(words))
            start = chance.randint(0, len(words) - size)
            form = words[start : start + size]
        if filler and number % 2:
            before, after = (chance.sample(filler, min(len(filler), chance.randint(0, 8))) for _ in range(2))
            form = [*before, *form, *after]
        forms.append(form)
    return forms


def _regression(rows: list[np.ndarray], labels: np.ndarray, width: int, classes: int, rounds: int = 200) -> tuple:
    """Sparse multinomial logistic regression by gradient steps that adapt to each weight."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    features = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    weights, bias = np.zeros((width, classes)), np.zeros(classes)
    squares, bias_squares = np.full_like(weights, 1e-8), np.full(classes, 1e-8)
    target = np.eye(classes)[labels]
    for _ in range(rounds):
        scores = np.tile(bias, (len(rows), 1))
        np.add.at(scores, at, weights[features])
        scores -= scores.max(1, keepdims=True)
        shares = np.exp(scores)
        error = target - shares / shares.sum(1, keepdims=True)
        slope = np.zeros_like(weights)
        np.add.at(slope, features, error[at])
        slope -= 0.01 * weights
        squares += slope**2
        bias_squares += error.sum(0) ** 2
        weights += 0.5 * slope / np.sqrt(squares)
        bias += 0.5 * error.sum(0) / np.sqrt(bias_squares)
    return weights, bias


def fit_model(lines: list[str], templates: dict[str, tuple[str, ...]] = TEMPLATES, seed: int = 7) -> LicenceModel:
    """Fits and calibrates the classifier; ``lines`` are paragraphs of the corpus.

    Lines that look like a template are not taken for ordinary ones.
    """
    chance = random.Random(seed)
    known = [(family, _pairs(words_of(t))) for family, texts in templates.items() for t in texts]
    plain = []
    for words in map(words_of, lines):
        own = _pairs(words)
        if words and all(len(own & pairs) < 0.4 * len(pairs) for _, pairs in known):
            plain.append(words)
    filler = [word for words in plain for word in words][:FILLER_WORDS]
    classes = (_NONE, *templates)
    grams: dict[str, int] = {}
    for texts in templates.values():
        for text in texts:
            for gram in _grams(words_of(text)):
                grams.setdefault(gram, len(grams))
    examples = [(0, words) for words in plain] + [(0, [])]
    for number, texts in enumerate(templates.values(), 1):
        for text in texts:
            examples += [(number, form) for form in _changed_forms(words_of(text), filler, chance)]
    chance.shuffle(examples)
    rows = [np.array([grams[g] for g in dict.fromkeys(_grams(words)) if g in grams], np.int64) for _, words in examples]
    labels = np.array([label for label, _ in examples])
    held = np.arange(len(rows)) % 5 == 0
    weights, bias = _regression(
        [row for row, out in zip(rows, held, strict=True) if not out], labels[~held], len(grams), len(classes)
    )
    scores = np.array([bias + weights[row].sum(0) for row, out in zip(rows, held, strict=True) if out])

    def loss(temperature: float) -> float:
        scaled = scores / temperature
        scaled -= scaled.max(1, keepdims=True)
        return float(-(scaled[np.arange(len(scaled)), labels[held]] - np.log(np.exp(scaled).sum(1))).mean())

    return LicenceModel(classes, grams, weights, bias, min(np.geomspace(0.2, 5, 41), key=loss))


def sample_lines(docs: DataFrame, text_column: str = "text", most: int = MAX_LINES) -> list[str]:
    """Different paragraphs of the corpus, at most ``most``: those with the least hashes.

    The lines are counted first. The count gives a threshold that about ``_SPARE * most`` lines
    stay below, so no task is sent more than that, and equal lines are merged before.
    """
    text = F.col(text_column)
    count = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) + 1
    total = docs.agg(F.sum(count.cast("long"))).first()[0] or 0
    lines = docs.select(F.explode(F.split(text, "\n")).alias("line")).filter(
        F.char_length("line").between(1, LINE_CHARACTERS)
    )
    hashed = lines.select("line", F.pmod(F.xxhash64("line"), F.lit(_HASHES)).alias("h"))
    if total > _SPARE * most:
        hashed = hashed.filter(F.col("h") < _HASHES * _SPARE * most // total)
    return [row["line"] for row in hashed.dropDuplicates(["line"]).orderBy("h", "line").limit(most).collect()]


def _confirmation(words: list[str], templates: list[set]) -> float:
    """The largest share of a template's words and word pairs that the paragraph has."""
    own = _pairs(words)
    return max((len(own & pairs) / len(pairs) for pairs in templates), default=0.0)


def scan(
    docs: DataFrame,
    model: LicenceModel,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per paragraph that states a licence.

    Columns: id, ``paragraph`` (its line, from 0), ``family``, ``probability`` (of any
    licence), ``family_probability``, ``template_share`` and ``statement`` (the paragraph).
    """
    names = ("paragraph", "family", "probability", "family_probability", "template_share", "statement")
    types = (pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.string())
    compared = {family: [_pairs(words_of(t)) for t in texts] for family, texts in templates.items()}
    state: dict[str, TokenTable] = {}

    def judged(number: int, line: str) -> tuple | None:
        words = words_of(line)
        shares = model.probabilities(words)
        likely = 1 - shares[0]
        if likely < LIKELY:
            return None
        best = int(shares[1:].argmax()) + 1
        family = model.classes[best]
        share = _confirmation(words, compared[family])
        return number, family if share >= CONFIRMED else UNKNOWN, float(likely), float(shares[best]), share, line

    def statements(numbers: list[int], lines: list[str]) -> list[tuple]:
        """What lines that follow each other state, each for itself or wrapped."""
        alone = [found for number in numbers if (found := judged(number, lines[number]))]
        open_ones = [found[0] for found in alone if found[1] == UNKNOWN]
        if not open_ones or len(numbers) == 1:
            return alone
        # Up to the confirmed statements, a run may be one statement over several lines.
        result = [found for found in alone if found[1] != UNKNOWN]
        closed = {found[0] for found in result}
        runs: list[list[int]] = [[]]
        for number in numbers:
            if number in closed:
                runs.append([])
            else:
                runs[-1].append(number)
        by_number = {found[0]: found for found in alone}
        for own in runs:
            parts = [by_number[number] for number in own if number in by_number]
            whole = judged(parts[0][0], " ".join(lines[own[0] : own[-1] + 1])) if parts and len(own) > 1 else None
            result += [whole] if whole and whole[1] != UNKNOWN else parts
        return sorted(result)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        grams = model.grams
        # Every n-gram of a template has a telling word, which is an n-gram itself.
        table = state.setdefault("table", TokenTable(lambda t: (t.strip(_EDGES).lower() in grams,), (bool,)))
        owner, rows = [], []
        for row, text in enumerate(texts_of(batch.column(1))):
            lines = text.split("\n")
            tokens = [line.split() for line in lines]
            counts = np.array([len(words) for words in tokens], np.int64)
            known = table.values([word for words in tokens for word in words])[0]
            totals = np.concatenate(([0], np.cumsum(known)))
            ends = np.cumsum(counts)
            telling = np.flatnonzero(totals[ends] > totals[ends - counts])
            for together in np.split(telling, np.flatnonzero(np.diff(telling) > 1) + 1):
                found = statements(together.tolist(), lines)
                owner += [row] * len(found)
                rows += found
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(owner, pa.int32())),
                *[pa.array(values, kind) for values, kind in zip(columns, types, strict=True)],
            ],
            names=["id", *names],
        )

    kind = docs.schema[id_column].dataType.simpleString()
    pairs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = (
        f"id {kind}, paragraph long, family string, probability double, family_probability double, "
        "template_share double, statement string"
    )
    return map_batches(pairs, run, schema).withColumnRenamed("id", id_column)
