from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from matrixmill.plans import joins
from matrixmill.plans.joins import hot_keys, lookup_join, measured_bytes


@pytest.fixture
def facts(spark):
    """A third of the rows hold key 0, some hold no key, key 9 is not in the lookup."""
    return spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'k0' WHEN id % 100 = 1 THEN NULL ELSE concat('k', id % 10) END AS key",
        "id AS value",
    )


@pytest.fixture
def lookup(spark):
    """Key 1 occurs twice."""
    return spark.createDataFrame(
        [(f"k{i}", f"name {i}") for i in [0, 1, 1, *range(2, 9)]], "key string, name string"
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_the_plain_join(facts, lookup, rows, how):
    plain = facts.join(lookup, "key", how)
    for limit in (0, 10**6):
        joined = lookup_join(facts, lookup, "key", how, broadcast_bytes=limit)
        assert joined.columns == plain.columns
        assert rows(joined) == rows(plain)


def test_small_lookup_is_broadcast_and_facts_stay(facts, lookup):
    plan = lookup_join(facts, lookup, "key")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_keys_without_a_large_share_are_not_repeated(spark, lookup):
    uniform = spark.range(4000).selectExpr("concat('k', id % 1000) AS key", "id AS value")
    joined = lookup_join(uniform, lookup, "key", broadcast_bytes=0)
    assert "_salt" not in _plan(joined) and "ResolvedHint" not in _plan(joined)


def test_hot_keys_are_cut_by_their_count(facts):
    found = hot_keys(facts, "key", 100)
    counts = {row["key"]: row["count"] for row in facts.groupBy("key").count().collect()}
    assert found == {
        key: -(-100 * count // 3000) for key, count in counts.items() if key and 100 * count > 3000
    }
    assert found["k0"] > 30 and sum(found.values()) < 200
    assert hot_keys(facts.limit(0), "key") == {}


def test_only_hot_keys_are_salted(spark, facts, lookup, rows, monkeypatch):
    monkeypatch.setattr(joins, "PIECES", 9)
    wide = facts.unionByName(facts.selectExpr("concat(key, '-', value) AS key", "value"))
    assert set(hot_keys(wide, "key", 9)) == {"k0"}
    joined = lookup_join(wide, lookup, "key", "left", broadcast_bytes=0)
    assert rows(joined) == rows(wide.join(lookup, "key", "left"))
    assert "_salt" in _plan(joined)


def test_equal_rows_of_a_hot_key_are_spread(spark):
    same = spark.range(0, 2000, 1, 8).selectExpr("'k0' AS key", "1 AS value")
    places = same.select(F.pmod(joins._place(same), F.lit(500)).alias("p")).distinct().count()
    assert places == 8


def test_the_lookup_is_computed_once(spark, facts, lookup):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    derived = lookup.coalesce(1).mapInArrow(counted, lookup.schema)
    for limit in (0, 10**6):
        before = calls.value
        lookup_join(facts, derived, "key", broadcast_bytes=limit).collect()
        assert calls.value - before == lookup.count()


def test_measured_bytes_bounds_the_values(spark):
    df = spark.createDataFrame([("abc", 1.0), (None, 2.0), ("é", None)], "s string, x double")
    assert measured_bytes(df) == 3 * 2 * 16 + 3 + 2
    assert measured_bytes(df.limit(0)) == 0
