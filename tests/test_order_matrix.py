"""The derived matrix on order tables with rows that the given ones don't have."""

from __future__ import annotations

from matrixmill.sources import order_matrix


def store(spark, base, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{base}/{name}.parquet")


def test_no_line_nation_or_fraction_is_lost(spark, tmp_path):
    base = str(tmp_path)
    store(spark, base, "nation", [(0,), (3,)], "n_nationkey int")
    store(spark, base, "supplier", [(1, 0), (2, 7), (3, None), (None, 3)], "s_suppkey long, s_nationkey int")
    lines = [
        (10, 1, 1.25, "R"), (10, 1, 2.5, "N"), (10, 2, 4.0, "A"), (11, 3, 8.5, "R"), (11, 99, 16.0, "N"),
        (11, None, 32.0, "A"), (12, 2, 0.125, "R"),
    ]
    store(spark, base, "lineitem", lines, "l_partkey long, l_suppkey long, l_quantity double, l_returnflag string")
    store(spark, base, "part", [(10,), (11,), (12,)], "p_partkey long")
    # Nations of either table, and one more for lines without any.
    assert order_matrix.sample_keys(spark, base) == [0, 3, 7, 8]
    matrix = order_matrix.raw_matrix(spark, base)
    assert matrix.columns == [order_matrix.RAW_GENE_COLUMN, "nat-00", "nat-03", "nat-07", "nat-08"]
    assert dict(matrix.dtypes)["nat-00"] == "string" and dict(matrix.dtypes)["nat-07"] == "double"
    rows = {row[0]: tuple(row)[1:] for row in matrix.collect()}
    assert rows == {
        "ENSG00000000010.2": ("3.750000", None, 4.0, None),
        "ENSG00000000011.3": (None, None, None, 56.5),
        "ENSG00000000012.4": (None, None, 0.125, None),
        "N_multimapping": ("1.250000", None, 0.125, 8.5),
        "N_noFeature": (None, None, 4.0, 32.0),
    }
    total = sum(float(x) for name, row in rows.items() if name[0] == "E" for x in row if x is not None)
    assert total == sum(line[2] for line in lines)


def test_genes_shuffle_once(spark, data_dir="/root/testdata/sf0.001"):
    plan = order_matrix.raw_matrix(spark, data_dir)._jdf.queryExecution().executedPlan().toString()
    genes = plan.split("Union")[1].split("l_returnflag")[0]
    assert genes.count("Exchange hashpartitioning") == 1


def test_json_lines_equal_the_array_documents(spark, rows, tmp_path):
    from matrixmill.sources.matrix import matrix_schema, read_raw_counts

    base = "/root/testdata/sf0.001"
    array = order_matrix.write_raw_matrix(spark, base, str(tmp_path / "a"))
    lines = order_matrix.write_raw_lines(spark, base, str(tmp_path / "l"))
    fields = order_matrix.sample_fields(order_matrix.sample_keys(spark, base))
    schema = matrix_schema(order_matrix.RAW_GENE_COLUMN, fields, [k for k, v in fields.items() if v == "string"])
    first = read_raw_counts(spark, array, schema=schema)
    assert rows(first) == rows(read_raw_counts(spark, lines, multi_line=False, schema=schema))
    assert len(list((tmp_path / "l").glob("part-*.json"))) == 2
