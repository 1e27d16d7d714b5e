"""Incremental document ingestion and enrichment expressed as Spark DataFrames."""

__version__ = "0.1.0"
