from __future__ import annotations

import random

import pytest

from matrixmill.llm import licenses


@pytest.fixture(scope="module")
def lines():
    chance = random.Random(4)
    common = "the of and to in is under license work rights public free any person notice file source".split()
    made = ["".join(chance.choices("abcdefgh", k=chance.randint(3, 9))) for _ in range(300)]
    return [" ".join(chance.choice(common if chance.random() < 0.3 else made) for _ in range(20)) for _ in range(400)]


@pytest.fixture(scope="module")
def model(lines):
    return licenses.fit_model(lines)


def test_families_and_ordinary_lines(spark, model, lines):
    texts = [(i, f"{lines[i]}\n{t}\n{lines[-i]}") for i, t in enumerate(t for ts in licenses.TEMPLATES.values() for t in ts)]
    families = [family for family, ts in licenses.TEMPLATES.items() for _ in ts]
    rows = licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    found = {row["doc_id"]: row["family"] for row in rows if row["paragraph"] == 1}
    assert found == dict(enumerate(families))
    assert len(rows) - len(found) <= 1


def test_held_out_forms(model, lines):
    chance = random.Random(99)
    right = total = 0
    for family, texts in licenses.TEMPLATES.items():
        for text in texts:
            for form in licenses._changed_forms(licenses.words_of(text), lines[0].split(), chance)[:20]:
                shares = model.probabilities(form)
                right += model.classes[int(shares.argmax())] == family
                total += 1
    assert right / total > 0.9
    plain = [model.probabilities(licenses.words_of(line))[0] for line in lines]
    assert sum(p > 0.5 for p in plain) / len(plain) > 0.97


def test_a_statement_without_template_is_unknown(spark, model):
    text = "licensed under the public license of this software work granted free of charge"
    rows = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert [row["family"] for row in rows] == ["unknown"]


def test_passed_over_paragraphs_are_like_empty_ones(model):
    assert model.probabilities(["zzz", "of", "the"]).tolist() == model.probabilities([]).tolist()
    assert model.probabilities([])[0] > licenses.LIKELY


def test_awkward_rows(spark, model, awkward, no_documents):
    assert licenses.scan(awkward, model).collect() == []
    assert licenses.scan(no_documents, model).collect() == []
    assert licenses.sample_lines(no_documents) == []
    again = licenses.fit_model([])
    frame = spark.createDataFrame([(1, "Released under the MIT License.")] * 2, "doc_id long, text string")
    assert [row["family"] for row in licenses.scan(frame, again).collect()] == ["mit", "mit"]


def test_query(spark, data, texts):
    from matrixmill.llm.queries import op4_licenses

    known = {t for ts in licenses.TEMPLATES.values() for t in ts}
    rows = op4_licenses(spark, data).collect()
    found = {(row["doc_id"], row["paragraph"]) for row in rows if row["family"] != "unknown"}
    lines = {(k, n) for k, t in texts.items() for n, line in enumerate((t or "").split("\n")) if line in known}
    assert lines <= found


def test_wrapped_statements_are_one_paragraph(spark, model, lines):
    grant = licenses.TEMPLATES["mit"][1].split()
    wrapped = [" ".join(grant[:9]), " ".join(grant[9:18]), " ".join(grant[18:])]
    text = "\n".join([lines[0], "zzz yyy", *wrapped, "xxx www", licenses.TEMPLATES["apache"][0]])
    rows = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    found = [(row["family"], row["paragraph"]) for row in rows if row["family"] != "unknown"]
    assert [family for family, _ in found] == ["mit", "apache"] and found[1] == ("apache", 6)
    assert 2 <= found[0][1] <= 4
    mit = next(row["statement"] for row in rows if row["family"] == "mit")
    assert all(part in mit for part in wrapped)


def test_other_wording_is_found_and_mostly_named(spark, model):
    """Statements in words that no template has, and sentences about licences that state none."""
    stated = {
        "mit": ["This project is distributed under the terms of the MIT License", "Code: MIT License."],
        "apache": ["The code is available under the Apache License, Version 2.0", "Apache License, Version 2.0"],
        "gpl": ["You may use it under the GNU General Public License, version 3", "GNU General Public License version 3"],
        "bsd": ["Sources come under the BSD 3-Clause License", "It is BSD 3-Clause licensed"],
    }
    rows = [(family, text) for family, texts in stated.items() for text in texts]
    frame = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    named = {row["doc_id"]: row["family"] for row in licenses.scan(frame, model).collect()}
    assert sum(i in named for i in range(len(rows))) >= 6
    assert sum(named.get(i) == family for i, (family, _) in enumerate(rows)) >= 4
    assert all(named[i] in (rows[i][0], "unknown") for i in named)
    idle = ["He was granted permission to leave", "the public library lends free software", "in source and binary form"]
    other = spark.createDataFrame(list(enumerate(idle)), "doc_id long, text string")
    assert [row["family"] for row in licenses.scan(other, model).collect() if row["family"] != "unknown"] == []


def test_the_sample_is_the_lines_of_least_hash(spark):
    rows = [(i, "\n".join(f"line {i} {k}" for k in range(20)) + "\nsame line\n" + "x" * 2000) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    picked = licenses.sample_lines(docs, most=50)
    assert len(picked) == len(set(picked)) == 50
    assert picked == licenses.sample_lines(docs.coalesce(1), most=5000)[:50]
