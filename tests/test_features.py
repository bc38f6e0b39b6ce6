from __future__ import annotations

import math

import pytest

from matrixmill.operators import reports
from matrixmill.operators.features import build_gene_features, build_sample_features

SCHEMA = (
    "sample_uuid string, gene_id string, gene_name string, count double, "
    "library_size double, cpm double, log1p_cpm double"
)


def normalised(sample, counts):
    library = sum(counts)
    for i, count in enumerate(counts, start=1):
        cpm = count * 1e6 / library
        yield (sample, f"ENSG{i}", f"GENE{i}", count, library, cpm, math.log1p(cpm))


@pytest.fixture
def norm(spark):
    data = [*normalised("a", [100.0, 100.0, 200.0, 0.0]), *normalised("b", [500.0, 0.0, 0.0, 0.0])]
    return spark.createDataFrame(data, SCHEMA)


def test_sample_features(norm):
    df = build_sample_features(norm)
    assert df.dtypes == [
        ("sample_uuid", "string"), ("library_size", "double"), ("avg_log1p_cpm", "double"),
        ("num_zero_genes", "bigint"), ("num_detected_genes", "bigint"), ("pct_zero_genes", "double"),
    ]
    by_sample = {row["sample_uuid"]: row for row in df.collect()}
    assert len(by_sample) == 2
    assert by_sample["a"][3:] == (1, 3, 0.25)
    assert by_sample["b"][3:] == (3, 1, 0.75)
    assert by_sample["a"]["library_size"] == 400.0
    assert by_sample["b"]["avg_log1p_cpm"] == pytest.approx(math.log1p(1e6) / 4)


def test_sample_of_negative_counts_has_no_share(spark):
    df = spark.createDataFrame([("n", "ENSG1", "G", -1.0, -1.0, None, None)], SCHEMA)
    assert build_sample_features(df).first()["pct_zero_genes"] is None


def test_gene_features(norm):
    df = build_gene_features(norm)
    assert df.columns == [
        "gene_id", "gene_name", "mean_log1p_cpm", "std_log1p_cpm",
        "num_samples_detected", "num_samples_total", "pct_samples_detected",
    ]
    by_gene = {row["gene_name"]: row for row in df.collect()}
    assert by_gene["GENE1"][4:] == (2, 2, 1.0)
    assert by_gene["GENE2"][4:] == (1, 2, 0.5)
    assert by_gene["GENE4"]["std_log1p_cpm"] == 0.0
    values = [math.log1p(250_000), math.log1p(1e6)]
    assert by_gene["GENE1"]["mean_log1p_cpm"] == pytest.approx(sum(values) / 2)
    assert by_gene["GENE1"]["std_log1p_cpm"] == pytest.approx(abs(values[0] - values[1]) / 2**0.5)


def test_single_sample_has_no_spread(spark):
    df = spark.createDataFrame([next(normalised("a", [1.0]))], SCHEMA)
    assert build_gene_features(df).first()["std_log1p_cpm"] is None


def test_gene_without_symbol_is_a_group_of_its_own(spark, rows):
    data = [("a", "ENSG1", None, 1.0, 1.0, 1.0, 1.0), ("a", "ENSG1", "", 1.0, 1.0, 1.0, 1.0)]
    df = build_gene_features(spark.createDataFrame(data, SCHEMA))
    assert rows(df, "gene_name", "num_samples_total") == [("", 1), (None, 1)]


def test_report_aggregates(norm, rows):
    assert rows(reports.counts_by_gene_name(norm)) == [
        ("GENE1", 600.0), ("GENE2", 100.0), ("GENE3", 200.0), ("GENE4", 0.0),
    ]
    assert rows(reports.avg_count_by_gene(norm))[0] == ("ENSG1", 300.0)
    assert rows(reports.counts_by_gene(norm))[2] == ("ENSG3", 200.0)
    assert rows(reports.counts_by_gene_sample(norm))[1] == ("ENSG1", "b", 500.0)
    assert rows(reports.count_range(norm)) == [(0.0, 500.0)]


def test_cluster_profile(spark):
    df = spark.createDataFrame(
        [(0, 100.0, 0.2), (0, 300.0, 0.4), (1, 50.0, 0.5)],
        "cluster int, library_size double, pct_zero_genes double",
    )
    first, second = reports.cluster_profile(df).orderBy("cluster").collect()
    assert first["num_samples"] == 2
    assert first["mean_library_size"] == 200.0
    assert first["std_library_size"] == pytest.approx(20_000**0.5)
    assert first["mean_pct_zero_genes"] == pytest.approx(0.3)
    assert second["std_library_size"] is None


def test_residuals(spark):
    df = spark.createDataFrame([(10.0, 8.0)], "target_library_size double, pred_library_size double")
    assert reports.prediction_residuals(df).first()["residual"] == 2.0
