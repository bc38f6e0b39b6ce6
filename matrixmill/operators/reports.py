"""Aggregates behind the documented report and plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixmill.functions.names import COUNT, GENE_ID, GENE_NAME, LIBRARY_SIZE, SAMPLE


def cluster_profile(df: DataFrame, cluster_column: str = "cluster") -> DataFrame:
    """Mean and standard deviation of depth and zero share per cluster."""
    return df.groupBy(cluster_column).agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.avg(LIBRARY_SIZE).alias("mean_library_size"),
        F.stddev_samp(LIBRARY_SIZE).alias("std_library_size"),
        F.avg("pct_zero_genes").alias("mean_pct_zero_genes"),
        F.stddev_samp("pct_zero_genes").alias("std_pct_zero_genes"),
    )


def counts_by_gene_name(df: DataFrame, count_column: str = COUNT) -> DataFrame:
    return df.groupBy(GENE_NAME).agg(F.sum(count_column).alias("total_count"))


def avg_count_by_gene(df: DataFrame, count_column: str = COUNT) -> DataFrame:
    return df.groupBy(GENE_ID).agg(F.avg(count_column).alias("avg_count"))


def counts_by_gene(df: DataFrame, count_column: str = COUNT) -> DataFrame:
    return df.groupBy(GENE_ID).agg(F.sum(count_column).alias("total_count"))


def counts_by_gene_sample(
    df: DataFrame, sample_column: str = SAMPLE, count_column: str = COUNT
) -> DataFrame:
    return df.groupBy(GENE_ID, sample_column).agg(F.sum(count_column).alias("total_count"))


def count_range(df: DataFrame, count_column: str = COUNT) -> DataFrame:
    return df.agg(F.min(count_column).alias("min_count"), F.max(count_column).alias("max_count"))


def prediction_residuals(
    df: DataFrame,
    target_column: str = "target_library_size",
    prediction_column: str = "pred_library_size",
) -> DataFrame:
    return df.withColumn("residual", F.col(target_column) - F.col(prediction_column))
