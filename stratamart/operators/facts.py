"""The sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FACT_COLUMNS
from .surrogate import with_surrogate_key


def sales_fact(clean: DataFrame, first_id: int = 0) -> DataFrame:
    """One row per order with a dense ``SalesID`` in order of ``OrderID``."""
    measures = clean.select(*FACT_COLUMNS)
    keyed = with_surrogate_key(measures, "SalesID", order_by="OrderID", start=first_id)
    return keyed.select("SalesID", *FACT_COLUMNS)


def year_month(date_column: str) -> Column:
    return F.date_format(date_column, "yyyy-MM").alias("yearmonth")


def with_year_month(rows: DataFrame, date_column: str = "OrderDate") -> DataFrame:
    return rows.withColumn("yearmonth", year_month(date_column))
