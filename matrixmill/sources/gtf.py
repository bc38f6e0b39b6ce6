"""Reader for GTF genome annotation files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The nine GTF fields in file order.
GTF_COLUMNS = (
    "chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attributes",
)


def read_gtf(spark: SparkSession, gtf_path: str) -> DataFrame:
    """Reads tab-separated GTF text, plain or compressed; ``#`` lines are skipped.

    All nine fields are strings. The schema is given, so no job runs to find it. A
    ``.gz`` file is one task; plain or bzip2 text is split. The rows are not
    redistributed here: keeping only the gene lines is done by the same task and
    leaves so little that a shuffle of all lines would cost more than it spreads.
    """
    schema = ", ".join(f"`{name}` string" for name in GTF_COLUMNS)
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("comment", "#")
        .csv(gtf_path)
    )
