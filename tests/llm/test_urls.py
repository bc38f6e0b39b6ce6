from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from matrixmill.llm import urls
from matrixmill.llm.queries import URL_RULES


def plain_parts(url: str | None) -> tuple[str, str]:
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host: str, path: str):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda rule: len(rule.name), default=None)


AWKWARD = [
    (1, "https://Www.Example.ORG/es/1?x=/de/"),
    (2, "https://example.org/en/12"),
    (3, "https://notexample.org/en/12"),
    (4, "http://a.com/de/?q=1&b=2#f"),
    (5, "http://acom/de/"),
    (6, "http://com/fr/"),
    (7, "http://a.org"),
    (8, "http://a.org?x"),
    (9, None),
    (10, ""),
    (11, "no scheme"),
    (12, "x\ny://É.Org/\np?"),
    (13, "http://u:p@a.net:80/a//b" + "/c" * 5000),
    (13, "http://u:p@a.net:80/a//b"),
    (None, "http://http://a.org/"),
]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(*row, "host") for row in AWKWARD], "page_id long, url string, host string")
    found = urls.judge(pages, URL_RULES)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    expected = []
    for key, url in AWKWARD:
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        expected.append((str(key), host, path, rule and rule.name, rule and rule.verdict))
    rows = [(str(r["page_id"]), r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in found.collect()]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    assert {row["verdict"] for row in found.collect()} <= {"allow", "block"}


def test_query_equals_brute_force_where_a_rule_decides(spark, data):
    from matrixmill.llm.queries import op6_url_filter

    url = {row["page_id"]: row["url"] for row in spark.read.parquet(f"{data}/pages.parquet").collect()}
    rows = op6_url_filter(spark, data).collect()
    assert {row["page_id"] for row in rows} == set(url) and len(rows) == len(url)
    for row in rows:
        host, path = plain_parts(url[row["page_id"]])
        rule = plain_rule(host, path)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule and rule.name)
        assert rule is None or row["verdict"] == rule.verdict


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(f"http://host{i}.example/{'a/' * (i % 3)}x", 0) for i in range(60)]
    rows += [(f"http://h-{i}-9{i}.example/{i}{i}{i}?a={i}&b={i}&c=1", 1) for i in range(60)]
    return spark.createDataFrame(rows, "url string, label int")


def test_trees_learn_from_labels(spark, labelled):
    pages = spark.createDataFrame(
        [(1, "http://new.example/a/b"), (2, "http://q-7-77.example/123?a=4&b=5&c=6")], "page_id long, url string"
    )
    found = {row["page_id"]: row["verdict"] for row in urls.judge(pages, (), labelled).collect()}
    assert found == {1: "allow", 2: "block"}


def test_labels_of_one_kind_and_none(spark, labelled):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    for rows, verdict in ((labelled.filter("label = 1"), "block"), (labelled.filter("label = 0"), "allow"), (None, "allow")):
        assert [row["verdict"] for row in urls.judge(pages, (), rows).collect()] == [verdict]
    assert urls.judge(pages.limit(0), URL_RULES).collect() == []


def test_entropy(spark):
    parts = urls.add_parts(spark.createDataFrame([("abab://",)], "url string"))
    row = urls.add_features(parts, urls.suffix_statistics(parts)).first()
    assert row["entropy"] == pytest.approx(2 * (2 / 7 * 1.8073549) + 1 / 7 * 2.8073549 + 2 / 7 * 1.8073549, abs=1e-5)
    assert (row["host_length"], row["depth"], row["parameters"]) == (0, 0, 0)


def test_held_out_urls_are_judged_as_the_rules_would(spark, data):
    """The trees learn from two thirds of the urls that rules decide, and see no rules."""
    from matrixmill.llm.queries import URL_RULES

    pages = spark.read.parquet(data.replace("sf0.001", "sf0.1") + "/pages.parquet").select("page_id", "url")
    ruled = urls.add_parts(pages).withColumn("truth", urls.rule_column(URL_RULES, "verdict")).filter("truth IS NOT NULL")
    ruled = ruled.withColumn("part", F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(3)))
    labelled = ruled.filter("part > 0").select("url", (F.col("truth") == "block").cast("int").alias("label"))
    held = ruled.filter("part = 0")
    judged = urls.judge(held.select("page_id", "url"), (), labelled).join(held.select("page_id", "truth"), "page_id")
    rows = judged.select("truth", "verdict").collect()
    right = sum(row["truth"] == row["verdict"] for row in rows)
    common = max(sum(row["truth"] == kind for row in rows) for kind in ("allow", "block"))
    # What the rules look at, letters of the path, is no lexical feature: the trees know part of it.
    assert len(rows) > 100 and right > common, (right, common, len(rows))
    assert right >= 0.75 * len(rows)


def test_suffix_statistics_mean_the_same_for_labels_and_pages(spark):
    pages = spark.createDataFrame([(i, f"https://a.{'b' if i % 4 else 'c'}.org/x{i}") for i in range(40)], "page_id long, url string")
    statistics = urls.suffix_statistics(urls.add_parts(pages))
    few = spark.createDataFrame([("https://q.b.org/y",), ("http://new.net/",), (None,)], "url string")
    rows = {row["url"]: row for row in urls.add_features(urls.add_parts(few), statistics).collect()}
    assert rows["https://q.b.org/y"]["suffix_share"] == 0.75 and rows["http://new.net/"]["suffix_share"] == 0.0
    assert len(rows) == 3
