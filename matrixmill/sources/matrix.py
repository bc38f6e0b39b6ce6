"""Reader for wide count matrices stored as JSON."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StringType, StructType


def matrix_schema(
    gene_column: str, samples: Iterable[str], text_samples: Iterable[str] = ()
) -> StructType:
    """Schema of a matrix: text genes, and samples of numbers except ``text_samples``."""
    text = set(text_samples)
    schema = StructType().add(gene_column, StringType())
    for name in samples:
        schema.add(name, StringType() if name in text else DoubleType())
    return schema


def read_raw_counts(
    spark: SparkSession,
    raw_path: str,
    multi_line: bool = True,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Reads one record per gene, one field per sample.

    ``multi_line=True`` expects each file to be one JSON array of records. Such a file
    cannot be split, so large matrices should come as a folder of them (one task per
    file) or as JSON lines with ``multi_line=False``, which Spark splits by bytes.

    Without ``schema`` Spark reads the input once more to infer it: columns are then
    sorted by name, and a column that is all null or mixes text and numbers is a string.
    With it, as a type or as text (:func:`matrix_schema` makes one), no job runs until the
    rows are used, the columns are those of the schema in its order, and fields it does not
    name are not read.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(raw_path)
