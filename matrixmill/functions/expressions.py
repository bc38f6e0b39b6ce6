"""Column expressions. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accession patterns, annotation attribute keys, CPM scale.
GENE_PREFIX = "ENSG"
GENE_BASE_PATTERN = "^(ENSG[0-9]+)"
GENE_ID_ATTRIBUTE = "gene_id"
GENE_NAME_ATTRIBUTE = "gene_name"
PER_MILLION = 1e6


def gene_base(gene_id: str) -> Column:
    """Accession without its version; ``''`` where there is none, null stays null."""
    return F.regexp_extract(gene_id, GENE_BASE_PATTERN, 1)


def gtf_attribute(attributes: str, key: str) -> Column:
    """Value of ``key "value"`` inside a packed attribute text; ``''`` if the key is absent."""
    return F.regexp_extract(attributes, f'{key} "([^"]+)"', 1)


def counts_per_million(count: str, library_size: str) -> Column:
    """The product comes first, so results are bit-equal to any engine doing the same.

    ``try_divide``: totals that were not filtered give null instead of an ANSI error.
    """
    return F.try_divide(F.col(count) * PER_MILLION, F.col(library_size))


def share(part: str, rest: str) -> Column:
    """``part / (part + rest)``, null when both are zero."""
    return F.try_divide(F.col(part), F.col(part) + F.col(rest))


def is_zero(count: str) -> Column:
    return F.col(count) == 0


def is_detected(count: str) -> Column:
    return F.col(count) > 0
