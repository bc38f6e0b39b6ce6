"""Where the tables of one data set live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

from matrixmill.sources.tables import DEFAULT_FORMAT

# Folders below the base path, and the default input files.
TABLE_FOLDERS = {
    "bronze_counts": "bronze/combined_counts_matrix_raw",
    "counts_long": "silver/counts_long",
    "gene_annotations": "reference/hg38/gene_annotations_delta",
    "counts_with_genes": "gold/counts_with_genes",
    "normalized_counts": "gold/normalized_counts",
    "sample_features": "gold/sample_features",
    "gene_features": "gold/gene_features",
    "sample_predictions": "gold/sample_predictions",
}
RAW_FILE = "raw/combined_counts_matrix.json"
GTF_FILE = "reference/hg38/Homo_sapiens.GRCh38.109.chr.gtf.gz"


@dataclass(frozen=True)
class Layout:
    """All paths below one base path, on any file system Spark can reach.

    ``raw_file`` and ``gtf_file`` may name a file or a folder of files. ``raw_multi_line``
    and ``raw_schema`` say how the matrix is read: as array documents or JSON lines, and
    with which columns; without a schema the columns are inferred.
    """

    base_path: str
    raw_file: str = RAW_FILE
    gtf_file: str = GTF_FILE
    table_format: str = DEFAULT_FORMAT
    raw_multi_line: bool = True
    raw_schema: StructType | str | None = None

    @property
    def raw_path(self) -> str:
        return self._below(self.raw_file)

    @property
    def gtf_path(self) -> str:
        return self._below(self.gtf_file)

    def table_path(self, table: str) -> str:
        return self._below(TABLE_FOLDERS[table])

    def _below(self, relative: str) -> str:
        return f"{self.base_path.rstrip('/')}/{relative}"
