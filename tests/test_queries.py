"""Every registered query against its SQL, run by DuckDB on the same tables."""

from __future__ import annotations

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from matrixmill.plans.oracles import ORACLES  # noqa: E402
from matrixmill.plans.queries import QUERIES  # noqa: E402

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_matrix_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, database, rows, name):
    df = contract.queries()[name](spark, str(DATA))
    expected = database.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    other = expected.select(*[f'"{column}"' for column in df.columns]).fetchall()
    by_text = lambda row: [(value is None, str(value)) for value in row]
    assert rows(df) == sorted(other, key=by_text)


def test_predictions_lie_within_the_training_range(spark):
    rows = contract.queries()["rf_predictions"](spark, str(DATA)).collect()
    assert len({row["sample_uuid"] for row in rows}) == len(rows) == 10
    assert all(row["in_training_range"] for row in rows)


def test_entry(spark):
    assert contract.entry(spark).count() == 200


def test_stored_bronze_is_filtered_by_the_scan(spark):
    plan = QUERIES["stored_gene_filter"](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(gene_id,ENSG)" in plan
