"""Column names of the tables, and name clean-up. Metadata only: no Spark job runs here."""

from __future__ import annotations

from collections.abc import Iterable

# Default column names of the stored tables.
GENE_ID = "gene_id"
SAMPLE = "sample_uuid"
COUNT = "count"
GENE_BASE = "gene_base"
GENE_NAME = "gene_name"
LIBRARY_SIZE = "library_size"
CPM = "cpm"
LOG_CPM = "log1p_cpm"

# How the exported gene column starts, and the characters a table
# column must not contain.
RAW_GENE_PREFIX = "Unnamed"
REPLACED_CHARACTERS = "-.:"

_TO_UNDERSCORE = str.maketrans(dict.fromkeys(REPLACED_CHARACTERS, "_"))


def sanitize_column_name(name: str) -> str:
    """``a-b.c:d`` -> ``a_b_c_d``; every other character stays."""
    return name.translate(_TO_UNDERSCORE)


def sanitize_column_names(columns: Iterable[str]) -> list[str]:
    return [sanitize_column_name(name) for name in columns]


def quoted(name: str) -> str:
    """``name`` as a SQL identifier, safe for spaces, leading digits and backticks."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """``value`` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
