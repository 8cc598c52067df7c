"""Measures and the daily run, put together from the operators."""
