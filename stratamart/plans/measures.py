"""Business measures over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum
from ..operators import as_of_join
from ..operators.facts import year_month


def month_start() -> Column:
    """The first day of a sale's month, to group by; only the groups are given its text."""
    return F.trunc("OrderDate", "month").alias("month")


def monthly_kpi(fact: DataFrame, one_row_per_order: bool = False) -> DataFrame:
    """Revenue, orders, average order value and customers by month.

    With ``one_row_per_order`` (true of ``sales_fact``) orders are counted as rows. That
    leaves a single distinct count, which Spark computes with two ordinary aggregations;
    two distinct counts make it copy every row for each of them first.
    """
    orders = F.count("OrderID") if one_row_per_order else F.count_distinct("OrderID")
    totals = fact.groupBy(month_start()).agg(
        exact_sum("TotalPrice").alias("revenue"),
        orders.alias("TotalOrders"),
        F.count_distinct("CustomerID").alias("UniqueCustomers"),
    )
    return totals.select(
        year_month("month"),
        F.round("revenue").alias("TotalRevenue"),
        "TotalOrders",
        F.round(F.try_divide("revenue", "TotalOrders")).alias("AverageOrderValue"),
        "UniqueCustomers",
    ).orderBy("yearmonth")


def regional_sales_trend(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue and units by store location and month.

    ``stores`` is the versioned store dimension. A sale counts for the location that its store
    had on its day, and once, however often the store has moved or been renamed; sales before
    the first version of their store have no location. Sales are added up per store and day
    before they meet the dimension, whichever store sells most.
    """
    per_store = fact.groupBy("StoreID", "OrderDate").agg(
        exact_sum("TotalPrice").alias("TotalPrice"), F.sum("Quantity").alias("Quantity")
    )
    placed = as_of_join(per_store, stores, {"StoreID": "StoreID"}, "OrderDate", ["StoreLocation"])
    return (
        placed.groupBy("StoreLocation", year_month("OrderDate"))
        .agg(
            F.round(exact_sum("TotalPrice"), 2).alias("TotalRevenue"),
            F.sum("Quantity").alias("UnitsSold"),
        )
    )
