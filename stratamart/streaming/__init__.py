"""Incremental ingestion."""

from .ingest import bronze_batches, bronze_days, has_bronze, ingest_available, read_bronze, read_malformed

__all__ = ["bronze_batches", "bronze_days", "has_bronze", "ingest_available", "read_bronze", "read_malformed"]
