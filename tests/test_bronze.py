from __future__ import annotations

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from matrixmill.functions.names import sanitize_column_name, sanitize_column_names
from matrixmill.operators.bronze import build_bronze_counts, ingest_bronze, rename_gene_column
from matrixmill.sources.matrix import read_raw_counts


def matrix(spark, *names):
    """A frame of one row whose first column is text, with the given column names."""
    kinds = ["string", *["double"] * (len(names) - 1)]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in zip(names, kinds))
    return spark.createDataFrame([("gene", *map(float, range(len(names) - 1)))], schema)


@given(st.uuids())
def test_uuids_lose_their_hyphens_only(value):
    clean = sanitize_column_name(str(value))
    assert clean.split("_") == str(value).split("-") and clean.replace("_", "") == value.hex


def test_names_keep_their_order():
    names = [f"{left}{sign}{right}" for left in "pq" for sign in ".:-_" for right in "rs"]
    assert sanitize_column_names(names) == [f"{name[0]}_{name[2]}" for name in names]


@given(st.text())
def test_sanitising_touches_only_three_characters(name):
    clean = sanitize_column_name(name)
    assert len(clean) == len(name)
    assert all(after == ("_" if before in "-.:" else before) for before, after in zip(name, clean))


@pytest.mark.parametrize("suffix", ["", ": 0", ": 12", "_level"])
def test_gene_column_is_renamed(spark, suffix):
    samples = [f"run {i}" for i in range(3)]
    renamed = rename_gene_column(matrix(spark, f"Unnamed{suffix}", *samples), "accession")
    assert renamed.columns == ["accession", *samples]


def test_only_the_first_unnamed_column_is_renamed(spark):
    df = spark.createDataFrame([(1.0, "g", 2)], "s double, `Unnamed: 0` string, Unnamed_1 int")
    assert rename_gene_column(df, "gene").columns == ["s", "gene", "Unnamed_1"]


@pytest.mark.parametrize("name", ["unnamed: 0", "UNNAMED", "my Unnamed", "accession"])
def test_without_an_exported_gene_column_the_columns_are_named(spark, name):
    with pytest.raises(ValueError, match=f"Unnamed.*{name}.*run 1"):
        rename_gene_column(matrix(spark, name, "run 0", "run 1"))


def test_bronze_renames_before_cleaning(spark):
    samples = ["x-1", "x:2", "x.3", "x 4"]
    assert build_bronze_counts(matrix(spark, "Unnamed: 0", *samples)).columns == [
        "gene_id", "x_1", "x_2", "x_3", "x 4"
    ]


def test_colliding_names_are_reported(spark):
    df = spark.createDataFrame([("g", 1.0, 2.0)], "`Unnamed: 0` string, `a-b` double, `A.b` double")
    with pytest.raises(ValueError, match=r"a-b.*A\.b"):
        build_bronze_counts(df)


@pytest.fixture
def records():
    return [
        {"Unnamed: 0": "ENSG1.1", "b-1": 3, "a-1": None, "c-1": "7"},
        {"Unnamed: 0": "ENSG2.1", "b-1": 4, "a-1": None, "c-1": 8},
    ]


def test_array_document_is_read_and_inferred(spark, rows, records, tmp_path):
    path = tmp_path / "matrix.json"
    path.write_text(json.dumps(records, indent=2))
    df = read_raw_counts(spark, str(path))
    assert df.dtypes == [
        ("Unnamed: 0", "string"), ("a-1", "string"), ("b-1", "bigint"), ("c-1", "string"),
    ]
    assert rows(df) == [("ENSG1.1", None, 3, "7"), ("ENSG2.1", None, 4, "8")]


def test_json_lines_give_the_same_rows(spark, rows, records, tmp_path):
    array, lines = tmp_path / "matrix.json", tmp_path / "matrix.jsonl"
    array.write_text(json.dumps(records))
    lines.write_text("\n".join(json.dumps(record) for record in records))
    first, second = read_raw_counts(spark, str(array)), read_raw_counts(spark, str(lines), False)
    assert first.dtypes == second.dtypes
    assert rows(first) == rows(second)


def test_given_schema_replaces_inference(spark, records, tmp_path):
    path = tmp_path / "matrix.json"
    path.write_text(json.dumps(records))
    schema = "`Unnamed: 0` string, `b-1` double"
    assert read_raw_counts(spark, str(path), schema=schema).dtypes == [
        ("Unnamed: 0", "string"), ("b-1", "double"),
    ]


def test_ingest_reads_and_cleans(spark, records, tmp_path):
    path = tmp_path / "matrix.json"
    path.write_text(json.dumps(records))
    assert ingest_bronze(spark, str(path)).columns == ["gene_id", "a_1", "b_1", "c_1"]
