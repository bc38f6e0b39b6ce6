from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from matrixmill.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def valid(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain_base(text: str | None) -> list[str]:
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, form in PLAIN.items()
        for m in re.finditer(form, text or "")
        if valid(kind, m.group())
    ]


def checked(rows, texts) -> None:
    for row in rows:
        base = plain_base(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest(), texts[row["doc_id"]]
        assert [row[f"n_{kind}"] for kind in PLAIN] == [sum(x.startswith(kind) for x in base) for kind in PLAIN]
        assert set(base) <= set(row["spans"].split(",")) | {""}


@pytest.fixture
def stored(spark, tmp_path):
    def store(texts):
        path = str(tmp_path / f"d{len(list(tmp_path.iterdir()))}.parquet")
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    return store


TRICKY = [
    "a@b.c_d@e.fg x@y @z.de q@w.e.r.t. a@b.c@d.e",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 12.3.4 1.2.3.4444444444444444444444",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 4111  1111 1111 1111",
    "+1 (017) 555-7713 +1 23 +12345678901234567 +1((((2 +49-30-1234567.. ++1 222 333 44",
    "😀é a@b.co 😀 1.1.1.1 ÉÉ +1 222 333 4444 😀",
    "x" * 3000 + "@" + "y" * 3000 + ".com " + "9" * 5000 + " " + "1 " * 20_000,
    "+1 " * 5000,
    "",
    None,
    "mail a@b.co\r\nc@d.ef\n\n1.2.3.4",
]


def test_tricky_texts(stored):
    found = pii.digest(pii.find_personal_data(stored(TRICKY))).collect()
    checked(found, dict(enumerate(TRICKY)))


def test_random_texts(stored):
    samples: list[str] = []

    @given(st.text(alphabet="ab1259.@+-() _%é😀\n", max_size=60))
    @settings(max_examples=1500, deadline=None, database=None, suppress_health_check=list(HealthCheck))
    def gather(text):
        samples.append(text)

    gather()
    checked(pii.digest(pii.find_personal_data(stored(samples))).collect(), dict(enumerate(samples)))


def test_query_equals_brute_force(spark, data, texts):
    from matrixmill.llm.queries import op10_pii

    rows = op10_pii(spark, data).collect()
    assert {row["doc_id"] for row in rows} == set(texts)
    checked(rows, texts)


def test_patterns_find_unseen_identifiers(stored):
    texts = [f"please call me at +1 555 200 {1000 + i} soon" for i in range(30)]
    texts += [f"the host address {10 + i}.0.0.7 answers" for i in range(30)]
    texts += ["please call me at 555-200-4477, soon", "the host address fe80::12ab:9:77 answers", "room 555-200-9999 is far"]
    rows = pii.digest(pii.find_personal_data(stored(texts))).collect()
    checked(rows, dict(enumerate(texts)))
    spans = {row["doc_id"]: row["spans"] for row in rows}
    assert spans[60] == "phone:18:30" and spans[61] == "ip:17:32" and spans[62] == ""


def test_instances_carry_over_to_other_patterns(stored):
    """A number found by one pattern makes another pattern known, which finds a further one."""
    texts = [f"please call me at +1 555 200 {1000 + i} soon" for i in range(40)]
    hidden = [f"555-200-{4000 + i}" for i in range(6)]
    texts += [f"please call me at {number} soon" for number in hidden]
    texts += [f"our direct line {number} rings" for number in hidden]
    texts += ["our direct line 555-200-7777 rings"]
    rows = {row["doc_id"]: row["spans"] for row in pii.digest(pii.find_personal_data(stored(texts))).collect()}
    assert rows[len(texts) - 1] == "phone:16:28"


def test_awkward_rows(awkward, no_documents):
    rows = pii.digest(pii.find_personal_data(awkward)).collect()
    assert len(rows) == 9 and sum(row["n_ip"] for row in rows) == 1
    assert pii.digest(pii.find_personal_data(no_documents)).collect() == []
