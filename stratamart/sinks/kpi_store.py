"""Monthly measures kept by adding and taking away orders.

A run reads the orders that were added to the fact and taken out of it, and the customers of
their months; the orders that stayed are not read. Kept are, per month, exact sums and
counts, and per month and customer the number of orders, so that a customer stops counting when
the last order goes::

    <path>/run_date=2024-05-02/totals/
    <path>/run_date=2024-05-02/customers/yearmonth=2024-05/
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..functions.aggregates import amount_parts, joined_amount
from ..operators.facts import year_month
from .runs import DAY, RunFolders
from .tables import replace_folder

# The columns of the two tables.
TOTALS = "yearmonth string, Units decimal(28,0), Rest decimal(28,0), Orders bigint, Customers bigint"
CUSTOMERS = "CustomerID string, Orders bigint, yearmonth string"


class KpiStore(RunFolders):
    def read(self, as_of: datetime.date | None = None) -> DataFrame:
        """Revenue, orders, average order value and customers by month."""
        revenue = joined_amount(F.col("Units"), F.col("Rest"))
        return self._totals(self._require(as_of)).select(
            "yearmonth",
            F.round(revenue).alias("TotalRevenue"),
            F.col("Orders").alias("TotalOrders"),
            F.round(F.try_divide(revenue, "Orders")).alias("AverageOrderValue"),
            F.col("Customers").alias("UniqueCustomers"),
        )

    def read_customers(self, as_of: datetime.date | None = None) -> DataFrame:
        """``CustomerID, Orders, yearmonth``: how many orders a customer has in a month."""
        return self._customers(self._manifest(self._require(as_of))["months"])

    def apply(self, changes: DataFrame, run_date: datetime.date, replay: bool = False, whole: bool = False) -> None:
        """Count orders with ``Sign`` 1 in and those with -1 out; with ``whole`` start from nothing.

        A month whose last order goes is no longer listed. Taking out more than there is of a
        customer is an error, as the state is then not that of the fact the changes are of.
        """
        self.check_order(run_date, replay)
        previous = None if whole else self.latest(run_date - DAY)
        before = {} if previous is None else self._manifest(previous)["months"]
        self._begin(run_date)
        path = self._run(run_date)

        units, rest = amount_parts("TotalPrice")
        signed = changes.select(
            year_month("OrderDate"), "CustomerID", "Sign", (units * F.col("Sign")).alias("Units"), (rest * F.col("Sign")).alias("Rest")
        )
        # One shuffle of the changes serves both tables; a month and customer is one row after it.
        per_customer = signed.groupBy("yearmonth", "CustomerID").agg(
            F.sum("Sign").alias("Orders"),
            F.sum("Units").cast("decimal(28,0)").alias("Units"),
            F.sum("Rest").cast("decimal(28,0)").alias("Rest"),
        )
        replace_folder(per_customer, f"{path}/_changes")
        schema = "yearmonth string, CustomerID string, Orders bigint, Units decimal(28,0), Rest decimal(28,0)"
        deltas = self.spark.read.schema(schema).parquet(f"{path}/_changes")
        # Months are a few numbers a year.
        touched = {row["yearmonth"] for row in deltas.select("yearmonth").distinct().collect()}

        known = self._customers({month: run for month, run in before.items() if month in touched})
        orders = known.unionByName(deltas.where("CustomerID IS NOT NULL").select("CustomerID", "Orders", "yearmonth"))
        orders = orders.groupBy("yearmonth", "CustomerID").agg(F.sum("Orders").alias("Orders"))
        problem = F.concat(F.lit("orders taken out that were never counted: "), "CustomerID", F.lit(" "), "yearmonth")
        kept = F.when(F.col("Orders") < 0, F.raise_error(problem).cast("boolean")).otherwise(F.col("Orders") > 0)
        # A file or a few per month, not one per month and task.
        replace_folder(orders.where(kept).hint("rebalance", "yearmonth"), f"{path}/customers", ["yearmonth"])

        months = {month: run for month, run in before.items() if month not in touched}
        months |= dict.fromkeys(self._written(f"{path}/customers"), str(run_date))
        sums = deltas.select("yearmonth", "Units", "Rest", "Orders")
        if previous is not None:
            sums = sums.unionByName(self._totals(previous).select("yearmonth", "Units", "Rest", "Orders"))
        added = [F.sum(name).cast("decimal(28,0)").alias(name) for name in ("Units", "Rest")]
        sums = sums.groupBy("yearmonth").agg(*added, F.sum("Orders").alias("Orders")).where("Orders > 0")
        counted = self._customers({month: months[month] for month in touched if month in months})
        counted = counted.groupBy("yearmonth").agg(F.count(F.lit(1)).alias("Customers"))
        if previous is not None:
            others = self._totals(previous).where(~F.col("yearmonth").isin(sorted(touched)))
            counted = counted.unionByName(others.select("yearmonth", "Customers"))
        totals = sums.join(counted, "yearmonth", "left").withColumn("Customers", F.coalesce("Customers", F.lit(0)))
        replace_folder(totals.select("yearmonth", "Units", "Rest", "Orders", "Customers").coalesce(1), f"{path}/totals")
        self._finish(run_date, {"months": months})
        storage.remove(self.spark, f"{path}/_changes")

    def _written(self, path: str) -> list[str]:
        fields = (name.partition("=") for name in storage.child_names(self.spark, path))
        return [month for key, _, month in fields if key == "yearmonth"]

    def _totals(self, run: datetime.date) -> DataFrame:
        return self.spark.read.schema(TOTALS).parquet(f"{self._run(run)}/totals")

    def _customers(self, months: Mapping[str, str]) -> DataFrame:
        """Customers of some months; the month is taken from the manifest, not from the folders' names."""
        found = self.spark.createDataFrame([], CUSTOMERS)
        by_run: dict[str, list[str]] = {}
        for month, run in months.items():
            by_run.setdefault(run, []).append(month)
        for run, names in sorted(by_run.items()):
            base = f"{self._run(run)}/customers"
            reader = self.spark.read.schema(CUSTOMERS).option("basePath", base)
            found = found.unionByName(reader.parquet(*(f"{base}/yearmonth={name}" for name in names)))
        return found
