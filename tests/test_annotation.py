from __future__ import annotations

import gzip

import pytest

from matrixmill.operators.annotation import (
    add_gene_base,
    build_gene_annotations,
    extract_gene_annotations,
    join_gene_annotations,
)
from matrixmill.sources.gtf import GTF_COLUMNS, read_gtf

GTF_SCHEMA = ", ".join(f"`{name}` string" for name in GTF_COLUMNS)
ATTRIBUTES = (
    'gene_id "ENSG00000223972"; gene_version "5"; gene_name "DDX11L1"; '
    'gene_source "havana"; gene_biotype "transcribed_unprocessed_pseudogene";'
)


def line(feature="gene", attributes=ATTRIBUTES):
    return ("1", "havana", feature, "11869", "14409", ".", "+", ".", attributes)


def counts_of(spark, *triples):
    return spark.createDataFrame(list(triples), "gene_id string, sample_uuid string, count double")


def annotations_of(spark, *pairs):
    return spark.createDataFrame(list(pairs), "gene_id string, gene_name string")


def test_attributes_become_columns(spark, rows):
    df = extract_gene_annotations(spark.createDataFrame([line()], GTF_SCHEMA))
    assert df.columns == ["gene_id", "gene_name", "chrom", "start", "end", "strand"]
    assert rows(df) == [("ENSG00000223972", "DDX11L1", "1", "11869", "14409", "+")]


def test_only_gene_lines_count(spark):
    lines = [line(feature) for feature in ("gene", "transcript", "exon")]
    assert extract_gene_annotations(spark.createDataFrame(lines, GTF_SCHEMA)).count() == 1


def test_absent_symbol_is_empty_text(spark, rows):
    df = spark.createDataFrame([line(attributes='gene_id "ENSG1";')], GTF_SCHEMA)
    assert rows(extract_gene_annotations(df), "gene_id", "gene_name") == [("ENSG1", "")]


@pytest.mark.parametrize(
    ("gene_id", "base"),
    [
        ("ENSG00000223972.5", "ENSG00000223972"),
        ("ENSG00000227232", "ENSG00000227232"),
        ("N_multimapping", ""),
        ("ENSGR0001", ""),
        (None, None),
    ],
)
def test_version_is_stripped(spark, gene_id, base):
    df = spark.createDataFrame([(gene_id,)], "gene_id string")
    assert add_gene_base(df).first()["gene_base"] == base


def test_versioned_counts_meet_unversioned_annotations(spark, rows):
    joined = join_gene_annotations(
        counts_of(spark, ("ENSG00000223972.5", "a", 10.0), ("ENSG99999999999.1", "a", 3.0)),
        annotations_of(spark, ("ENSG00000223972", "DDX11L1")),
    )
    assert joined.columns == ["gene_id", "sample_uuid", "count", "gene_name"]
    assert rows(joined) == [
        ("ENSG00000223972.5", "a", 10.0, "DDX11L1"), ("ENSG99999999999.1", "a", 3.0, None),
    ]


def test_doubled_annotation_doubles_rows_unless_unique(spark, rows):
    counts = counts_of(spark, ("ENSG1.1", "a", 2.0))
    annotations = annotations_of(spark, ("ENSG1", "B"), ("ENSG1.7", ""), ("ENSG1", "A"))
    default = join_gene_annotations(counts, annotations)
    assert rows(default, "gene_name") == [("",), ("A",), ("B",)]
    unique = join_gene_annotations(counts, annotations, unique_annotations=True)
    assert rows(unique) == [("ENSG1.1", "a", 2.0, "A")]


def test_ids_without_accession_meet_unless_unique(spark, rows):
    counts = counts_of(spark, ("ENSGR0001", "a", 1.0))
    annotations = annotations_of(spark, ("LRG_1", "X"), ("ENSG1", ""))
    assert rows(join_gene_annotations(counts, annotations), "gene_name") == [("X",)]
    unique = join_gene_annotations(counts, annotations, unique_annotations=True)
    assert rows(unique, "gene_name") == [(None,)]


def test_unique_annotations_keep_the_three_states(spark, rows):
    joined = join_gene_annotations(
        counts_of(spark, ("ENSG1.1", "a", 1.0), ("ENSG2.1", "a", 1.0), ("ENSG3.1", "a", 1.0)),
        annotations_of(spark, ("ENSG1", "A"), ("ENSG2", "")),
        unique_annotations=True,
    )
    assert rows(joined, "gene_id", "gene_name") == [
        ("ENSG1.1", "A"), ("ENSG2.1", ""), ("ENSG3.1", None),
    ]


@pytest.mark.parametrize("compressed", [True, False])
def test_gtf_file_is_read(spark, rows, tmp_path, compressed):
    text = "#!genome-build GRCh38\n" + "".join(
        "\t".join(line(feature)) + "\n" for feature in ("gene", "exon")
    )
    path = tmp_path / ("a.gtf.gz" if compressed else "a.gtf")
    path.write_bytes(gzip.compress(text.encode()) if compressed else text.encode())
    lines = read_gtf(spark, str(path))
    assert lines.columns == list(GTF_COLUMNS)
    assert {kind for _, kind in lines.dtypes} == {"string"}
    assert rows(lines, "feature", "attributes") == [("exon", ATTRIBUTES), ("gene", ATTRIBUTES)]
    assert build_gene_annotations(spark, str(path)).first()["gene_name"] == "DDX11L1"
