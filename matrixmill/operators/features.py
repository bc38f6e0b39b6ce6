"""Summaries of normalised counts, per sample and per gene."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixmill.functions.expressions import is_detected, is_zero, share
from matrixmill.functions.names import COUNT, GENE_ID, GENE_NAME, LIBRARY_SIZE, LOG_CPM, SAMPLE


def build_sample_features(
    df_norm: DataFrame, sample_column: str = SAMPLE, count_column: str = COUNT
) -> DataFrame:
    """Depth, mean expression and detection per sample.

    ``library_size`` is the same on every row of a sample; ``max`` takes it without
    depending on row order.
    """
    return (
        df_norm.groupBy(sample_column)
        .agg(
            F.max(LIBRARY_SIZE).alias(LIBRARY_SIZE),
            F.avg(LOG_CPM).alias("avg_log1p_cpm"),
            F.count_if(is_zero(count_column)).alias("num_zero_genes"),
            F.count_if(is_detected(count_column)).alias("num_detected_genes"),
        )
        .withColumn("pct_zero_genes", share("num_zero_genes", "num_detected_genes"))
    )


def build_gene_features(df_norm: DataFrame, count_column: str = COUNT) -> DataFrame:
    """Mean, spread and detection per gene; the spread of a single sample is null."""
    return (
        df_norm.groupBy(GENE_ID, GENE_NAME)
        .agg(
            F.avg(LOG_CPM).alias("mean_log1p_cpm"),
            F.stddev_samp(LOG_CPM).alias("std_log1p_cpm"),
            F.count_if(is_detected(count_column)).alias("num_samples_detected"),
            F.count(F.lit(1)).alias("num_samples_total"),
        )
        .withColumn(
            "pct_samples_detected", F.col("num_samples_detected") / F.col("num_samples_total")
        )
    )
