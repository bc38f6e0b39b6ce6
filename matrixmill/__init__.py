"""Spark jobs that take a wide count matrix to analysis-ready expression tables."""

__version__ = "0.1.0"
