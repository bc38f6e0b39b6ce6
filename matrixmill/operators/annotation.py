"""Gene annotation table, and attaching gene symbols to counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixmill.functions.expressions import (
    GENE_ID_ATTRIBUTE,
    GENE_NAME_ATTRIBUTE,
    gene_base,
    gtf_attribute,
)
from matrixmill.functions.names import GENE_BASE, GENE_ID, GENE_NAME
from matrixmill.plans.joins import BROADCAST_BYTES, lookup_join
from matrixmill.sources.gtf import read_gtf


def extract_gene_annotations(df_gtf: DataFrame) -> DataFrame:
    """Gene lines of a GTF with accession and symbol taken out of the attributes."""
    genes = df_gtf.filter(F.col("feature") == "gene")
    return genes.select(
        gtf_attribute("attributes", GENE_ID_ATTRIBUTE).alias(GENE_ID),
        gtf_attribute("attributes", GENE_NAME_ATTRIBUTE).alias(GENE_NAME),
        "chrom",
        "start",
        "end",
        "strand",
    )


def add_gene_base(
    df: DataFrame, gene_id_column: str = GENE_ID, gene_base_column: str = GENE_BASE
) -> DataFrame:
    return df.withColumn(gene_base_column, gene_base(gene_id_column))


def join_gene_annotations(
    df_counts: DataFrame,
    df_annotations: DataFrame,
    gene_id_column: str = GENE_ID,
    gene_base_column: str = GENE_BASE,
    unique_annotations: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds ``gene_name`` to every count row by the accession without version.

    ``gene_name`` is null for genes the annotation lacks and ``''`` for annotated genes
    without a symbol. By default an accession annotated twice doubles its count rows,
    and ids without an accession meet each other on ``''``. ``unique_annotations``
    keeps one symbol per accession (the first by name) and leaves ``''`` unmatched, so
    that the number of rows never changes.
    """
    counts = add_gene_base(df_counts, gene_id_column, gene_base_column)
    symbols = add_gene_base(df_annotations, gene_id_column, gene_base_column).select(
        gene_base_column, GENE_NAME
    )
    if unique_annotations:
        symbols = (
            symbols.filter(F.col(gene_base_column) != "")
            .groupBy(gene_base_column)
            .agg(F.coalesce(F.min(F.nullif(F.col(GENE_NAME), F.lit(""))), F.lit("")).alias(GENE_NAME))
        )
    joined = lookup_join(counts, symbols, gene_base_column, "left", broadcast_bytes)
    return joined.drop(gene_base_column)


def build_gene_annotations(spark: SparkSession, gtf_path: str) -> DataFrame:
    return extract_gene_annotations(read_gtf(spark, gtf_path))
