"""Batch jobs: each reads stored tables, and overwrites others.

A job can be run again on its own. No job reads a table it writes.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from matrixmill.operators.annotation import build_gene_annotations, join_gene_annotations
from matrixmill.operators.bronze import ingest_bronze
from matrixmill.operators.features import build_gene_features, build_sample_features
from matrixmill.operators.modeling import ModelSettings, run_modeling
from matrixmill.operators.normalize import normalize_counts
from matrixmill.operators.silver import build_silver_counts
from matrixmill.plans.layout import Layout
from matrixmill.sources.tables import read_table, write_table

logger = logging.getLogger(__name__)


def _load(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    return read_table(spark, layout.table_path(table), layout.table_format)


def _store(df: DataFrame, layout: Layout, table: str, overwrite_schema: bool = False) -> DataFrame:
    """Writes a table and returns it as stored, so that later steps do not compute it again."""
    path = layout.table_path(table)
    write_table(df, path, overwrite_schema, layout.table_format)
    logger.info("wrote %s", path)
    return read_table(df.sparkSession, path, layout.table_format)


def run_bronze(spark: SparkSession, layout: Layout) -> None:
    bronze = ingest_bronze(
        spark, layout.raw_path, multi_line=layout.raw_multi_line, schema=layout.raw_schema
    )
    # Inferred types may change from one export to the next.
    _store(bronze, layout, "bronze_counts", overwrite_schema=True)


def run_silver(spark: SparkSession, layout: Layout) -> None:
    silver = build_silver_counts(_load(spark, layout, "bronze_counts"))
    _store(silver, layout, "counts_long", overwrite_schema=True)


def run_annotation(spark: SparkSession, layout: Layout) -> None:
    _store(build_gene_annotations(spark, layout.gtf_path), layout, "gene_annotations")


def run_gold(spark: SparkSession, layout: Layout) -> None:
    """Every table is read back once written: the annotation join runs once for all four."""
    counts = _load(spark, layout, "counts_long")
    annotations = _load(spark, layout, "gene_annotations")
    annotated = _store(join_gene_annotations(counts, annotations), layout, "counts_with_genes")
    normalized = _store(normalize_counts(annotated), layout, "normalized_counts")
    _store(build_sample_features(normalized), layout, "sample_features")
    _store(build_gene_features(normalized), layout, "gene_features")


def run_modeling_stage(
    spark: SparkSession, layout: Layout, settings: ModelSettings = ModelSettings()
) -> None:
    predictions, metrics = run_modeling(_load(spark, layout, "normalized_counts"), settings)
    logger.info("test metrics: %s", metrics)
    _store(predictions, layout, "sample_predictions")


#: Stages in the order in which they depend on each other.
STAGES = {
    "bronze": run_bronze,
    "silver": run_silver,
    "annotation": run_annotation,
    "gold": run_gold,
    "modeling": run_modeling_stage,
}


def run_pipeline(
    spark: SparkSession,
    layout: Layout,
    stage: str = "all",
    settings: ModelSettings = ModelSettings(),
) -> None:
    """Runs one stage, or all of them in order; ``settings`` are those of the models."""
    if stage != "all" and stage not in STAGES:
        raise ValueError(f"No stage {stage!r}; choose 'all' or one of {', '.join(STAGES)}.")
    options = {"modeling": {"settings": settings}}
    for name, run in STAGES.items():
        if stage in ("all", name):
            logger.info("stage %s", name)
            run(spark, layout, **options.get(name, {}))
