from __future__ import annotations

import gzip
import json
from dataclasses import replace

import pytest

from matrixmill.operators.modeling import ModelSettings
from matrixmill.plans import jobs
from matrixmill.plans.layout import TABLE_FOLDERS, Layout
from matrixmill.sources.matrix import matrix_schema, read_raw_counts
from matrixmill.sources.tables import read_table, write_table

SAMPLES = [f"s-{i}" for i in range(10)]


@pytest.fixture(scope="module")
def layout(tmp_path_factory):
    base = tmp_path_factory.mktemp("base")
    (base / "raw").mkdir()
    (base / "reference" / "hg38").mkdir(parents=True)
    matrix = [
        {"Unnamed: 0": f"ENSG{gene}.3", **{s: (gene * i) % 5 or None for i, s in enumerate(SAMPLES)}}
        for gene in range(1, 9)
    ]
    matrix.append({"Unnamed: 0": "N_noFeature", **dict.fromkeys(SAMPLES, 1000)})
    lines = ["#!header"] + [
        f'1\thavana\t{feature}\t1\t2\t.\t+\t.\tgene_id "ENSG{gene}"; gene_name "G{gene}";'
        for gene in range(1, 8)
        for feature in ("gene", "exon")
    ]
    layout = Layout(str(base))
    with open(layout.raw_path, "w") as file:
        json.dump(matrix, file)
    with gzip.open(layout.gtf_path, "wt") as file:
        file.write("\n".join(lines))
    return layout


@pytest.fixture(scope="module")
def table(spark, layout):
    jobs.run_pipeline(spark, layout)
    return lambda name: read_table(spark, layout.table_path(name))


def test_paths_below_the_base():
    layout = Layout("abfss://c@account/base/")
    assert layout.raw_path == "abfss://c@account/base/raw/combined_counts_matrix.json"
    assert layout.table_path("counts_long") == "abfss://c@account/base/silver/counts_long"


@pytest.mark.parametrize(
    ("name", "columns", "count"),
    [
        ("bronze_counts", ["gene_id", *[s.replace("-", "_") for s in SAMPLES]], 9),
        ("counts_long", ["gene_id", "sample_uuid", "count"], 80),
        ("gene_annotations", ["gene_id", "gene_name", "chrom", "start", "end", "strand"], 7),
        ("counts_with_genes", ["gene_id", "sample_uuid", "count", "gene_name"], 80),
        ("normalized_counts", ["sample_uuid", "gene_id", "count", "gene_name", "library_size",
                               "cpm", "log1p_cpm"], 64),
        ("sample_features", ["sample_uuid", "library_size", "avg_log1p_cpm", "num_zero_genes",
                             "num_detected_genes", "pct_zero_genes"], 8),
        ("gene_features", ["gene_id", "gene_name", "mean_log1p_cpm", "std_log1p_cpm",
                           "num_samples_detected", "num_samples_total", "pct_samples_detected"], 8),
        ("sample_predictions", ["sample_uuid", "library_size", "avg_count", "num_zero_genes",
                                "num_detected_genes", "pct_zero_genes", "PC1", "PC2", "cluster",
                                "pred_library_size", "target_library_size", "model_r2",
                                "model_rmse"], 8),
    ],
)
def test_every_table_is_stored(table, name, columns, count):
    stored = table(name)
    if name == "bronze_counts":
        assert sorted(stored.columns) == sorted(columns)
    else:
        assert stored.columns == columns
    assert stored.count() == count


def test_catalogue_is_complete():
    assert len(TABLE_FOLDERS) == 8


def test_gene_without_annotation_keeps_a_null_name(table, rows):
    assert rows(table("gene_features").filter("gene_name IS NULL"), "gene_id") == [("ENSG8.3",)]


def test_stages_can_run_again_alone(spark, layout, table, rows):
    before = rows(table("normalized_counts"))
    for stage in ("silver", "gold"):
        jobs.run_pipeline(spark, layout, stage)
    assert rows(read_table(spark, layout.table_path("normalized_counts"))) == before


def test_annotations_are_joined_once(spark, layout, table, monkeypatch):
    calls = []
    join = jobs.join_gene_annotations
    monkeypatch.setattr(jobs, "join_gene_annotations", lambda *a: calls.append(a) or join(*a))
    sources = []
    monkeypatch.setattr(
        jobs, "normalize_counts",
        lambda df, f=jobs.normalize_counts: sources.append(df.inputFiles()) or f(df),
    )
    jobs.run_gold(spark, layout)
    assert len(calls) == 1
    assert all("gold/counts_with_genes" in file for file in sources[0])


def test_unknown_stage_lists_the_known_ones(spark, layout):
    with pytest.raises(ValueError, match="bronze, silver, annotation, gold, modeling"):
        jobs.run_pipeline(spark, layout, "platinum")


def test_command_line(spark, layout, table, monkeypatch):
    from matrixmill import __main__ as cli

    ran = []
    monkeypatch.setattr(cli, "run_pipeline", lambda spark, *arguments: ran.append(arguments))
    cli.main(["--base-path", layout.base_path, "--stage", "silver"])
    assert ran == [(layout, "silver", ModelSettings())]


def test_command_line_names_every_model_setting(tmp_path):
    from matrixmill.__main__ import parse

    schema = tmp_path / "columns.ddl"
    schema.write_text("`Unnamed: 0` string, `s-1` double\n")
    given = ["--base-path", "/b", "--json-lines", "--raw-schema", str(schema), "--n-clusters", "4", "--max-depth", "3"]
    given += ["--n-estimators", "7", "--no-bootstrap", "--test-size", "0.5", "--random-state", "1", "--n-starts", "2"]
    args, layout, settings = parse(given)
    assert args.stage == "all" and not layout.raw_multi_line
    assert layout.raw_schema == "`Unnamed: 0` string, `s-1` double"
    assert settings == ModelSettings(
        n_clusters=4, max_depth=3, n_estimators=7, bootstrap=False, test_size=0.5, random_state=1, n_starts=2
    )


def test_settings_reach_the_models(spark, layout, table):
    other = replace(layout, base_path=f"{layout.base_path}/other")
    write_table(table("normalized_counts"), other.table_path("normalized_counts"))
    jobs.run_pipeline(spark, other, "modeling", ModelSettings(n_clusters=2, n_estimators=1, n_starts=1))
    stored = read_table(spark, other.table_path("sample_predictions"))
    assert {row["cluster"] for row in stored.select("cluster").collect()} == {0, 1}


def test_json_lines_with_a_schema_need_no_pass_to_infer_it(spark, tmp_path):
    """Reading starts no job, splits by bytes, and takes the columns the schema names."""
    records = [{"Unnamed: 0": f"ENSG{i}.1", "s-1": i, "s-2": str(i), "extra": 1} for i in range(2000)]
    path = tmp_path / "matrix.jsonl"
    path.write_text("\n".join(map(json.dumps, records)))
    schema = matrix_schema("Unnamed: 0", ["s-1", "s-2"], ["s-2"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.sparkContext.setJobGroup("lines", "lines")
    try:
        read = read_raw_counts(spark, str(path), multi_line=False, schema=schema)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("lines") == []
        assert read.schema == schema and read.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sum(row["s-1"] for row in read.collect()) == sum(range(2000))
    base = Layout(str(tmp_path), raw_file="matrix.jsonl", raw_multi_line=False, raw_schema=schema)
    jobs.run_pipeline(spark, base, "bronze")
    assert read_table(spark, base.table_path("bronze_counts")).columns == ["gene_id", "s_1", "s_2"]
