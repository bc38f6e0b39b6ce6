"""Raw matrix to Bronze: only names change."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from matrixmill.functions.names import GENE_ID, RAW_GENE_PREFIX, sanitize_column_names
from matrixmill.sources.matrix import read_raw_counts


def rename_gene_column(df: DataFrame, gene_id_column: str = GENE_ID) -> DataFrame:
    """Gives the first column named ``Unnamed…`` the name ``gene_id_column``."""
    exported = next((name for name in df.columns if name.startswith(RAW_GENE_PREFIX)), None)
    if exported is None:
        raise ValueError(
            f"The gene column should start with {RAW_GENE_PREFIX!r}, "
            f"but the first columns are {df.columns[:5]}."
        )
    return df.withColumnRenamed(exported, gene_id_column)


def build_bronze_counts(df_raw: DataFrame, gene_id_column: str = GENE_ID) -> DataFrame:
    """Renames the gene column, then cleans every column name."""
    df = rename_gene_column(df_raw, gene_id_column)
    clean = sanitize_column_names(df.columns)
    _refuse_collisions(df, clean)
    return df.toDF(*clean)


def _refuse_collisions(df: DataFrame, clean: list[str]) -> None:
    """Two samples under one name would fail later, at the write, and say less."""
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    sources = defaultdict(list)
    for before, after in zip(df.columns, clean):
        sources[after if case_sensitive else after.lower()].append(before)
    collisions = [names for names in sources.values() if len(names) > 1]
    if collisions:
        raise ValueError(f"Columns become equal once their names are cleaned: {collisions}")


def ingest_bronze(
    spark: SparkSession,
    raw_path: str,
    gene_id_column: str = GENE_ID,
    multi_line: bool = True,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Reads a matrix as :func:`read_raw_counts` does, and gives its columns clean names."""
    return build_bronze_counts(read_raw_counts(spark, raw_path, multi_line, schema), gene_id_column)
