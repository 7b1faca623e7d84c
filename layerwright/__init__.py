"""Medallion analytics operators for Spark: bronze ingestion, silver models, gold metrics."""

__version__ = "0.1.0"
