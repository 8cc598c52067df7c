"""Medallion warehouse jobs for Spark: conform, model, version and measure a sales feed."""
