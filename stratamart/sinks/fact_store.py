"""The sales fact, brought up to date by the orders of a day.

A run writes the months that gained or lost an order, and its manifest names for each month
the run that wrote it last, and the same for each bucket of the order index::

    <path>/run_date=2024-05-02/data/yearmonth=2024-05/
    <path>/run_date=2024-05-02/index/bucket=17/
    <path>/run_date=2024-05-02/changes/

All other months and buckets stay where they are. An order that comes in again replaces the stored
one, also if it moves to another month, and keeps its ``SalesID``; new orders are numbered on from
the last id in order of ``OrderID``. Of stored orders that none come in for, only those are looked
at that share a bucket of the index with one that does (``order_index``). The changes are the
rows that the run added, and with a minus sign those that it took out.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType
from pyspark.sql.types import StructField as Field
from pyspark.sql.types import StructType

from .. import storage
from ..operators.facts import year_month
from ..operators.surrogate import with_surrogate_key
from ..schemas import FACT_COLUMNS
from . import order_index
from .runs import DAY, RunFolders
from .tables import replace_folder

# The types of the columns that are not text.
TYPES = {
    "OrderDate": DateType(),
    "Quantity": IntegerType(),
    "UnitPrice": DoubleType(),
    "TotalPrice": DoubleType(),
}

# The columns of changes beside their sign.
CHANGE_COLUMNS = ["OrderID", "OrderDate", "CustomerID", "TotalPrice"]


class FactStore(RunFolders):
    """``buckets`` of the index are fixed by the first run: about orders / 4 million, 256 at least."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = 256):
        super().__init__(spark, path)
        ids = {"OrderID": IntegerType() if id_type == "int" else LongType()}
        kinds = TYPES | ids
        columns = [Field(name, kinds.get(name, StringType())) for name in FACT_COLUMNS]
        self.schema = StructType([Field("SalesID", LongType()), *columns])
        self.index_schema = order_index.SCHEMA.format(id_type=id_type)
        self.buckets = buckets

    def read(self, as_of: datetime.date | None = None) -> DataFrame:
        """The fact after the last run up to a day."""
        return self._load(self._manifest(self._require(as_of))["months"])

    def months(self, run_date: datetime.date) -> list[str]:
        """The months that gained or lost an order in a run."""
        return self._manifest(run_date)["touched"]

    def read_months(self, run_date: datetime.date) -> DataFrame:
        """The rows of these months after the run."""
        manifest = self._manifest(run_date)
        own = {month: manifest["months"][month] for month in manifest["touched"] if month in manifest["months"]}
        return self._load(own)

    def read_changes(self, run_date: datetime.date) -> DataFrame:
        """The orders that a run added (``Sign`` 1) and took out (-1).

        After a run with ``whole`` these are all orders of the fact.
        """
        kinds = {field.name: field for field in self.schema}
        schema = StructType([*(kinds[name] for name in CHANGE_COLUMNS), Field("Sign", IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self._run(run_date)}/changes")

    def read_index(self, as_of: datetime.date | None = None) -> DataFrame:
        """``OrderID, SalesID, yearmonth`` of every stored order."""
        return self._load_index(self._manifest(self._require(as_of))["index"])

    def look_up(self, orders: DataFrame, as_of: datetime.date | None = None) -> DataFrame:
        """The index rows of the stored ones among some orders; other buckets are not opened."""
        manifest = self._manifest(self._require(as_of))
        found, _ = self._candidates(order_index.SlotFilter.of(orders), manifest)
        return found.join(orders.select("OrderID").distinct(), "OrderID", "left_semi")

    def upsert(
        self,
        sales: DataFrame,
        run_date: datetime.date,
        replay: bool = False,
        whole: bool = False,
    ) -> None:
        """Record the orders of a day, one row each; with ``whole`` they are the whole fact."""
        self.check_order(run_date, replay)
        previous = self.latest(run_date - DAY)
        before = {"months": {}, "next_id": 0, "index": {}, "buckets": self.buckets}
        if previous is not None:
            before |= self._manifest(previous)
            if "index" not in self._manifest(previous):
                before["index"] = None
        if whole:
            stored = {"months": {}, "next_id": 0, "index": {}, "buckets": before["buckets"]}
        else:
            stored = before
        self._begin(run_date)

        orders = sales.select(*FACT_COLUMNS)
        candidates, touched_buckets = self._candidates(order_index.SlotFilter.of(orders), stored)
        old = candidates.select("OrderID", "SalesID", F.col("yearmonth").alias("old_month"))
        placed, fresh, again = self._place(orders.join(old, "OrderID", "left"), run_date, stored["next_id"])

        # Months are a few numbers a year.
        names = placed.select(F.explode(F.array("yearmonth", "old_month")).alias("month"))
        touched = {row["month"] for row in names.distinct().where("month IS NOT NULL").collect()}
        affected = self._load({month: run for month, run in stored["months"].items() if month in touched})
        ids = placed.select("OrderID")
        kept = affected.join(ids, "OrderID", "left_anti").withColumn("yearmonth", year_month("OrderDate"))
        rows = kept.unionByName(placed.drop("old_month"))
        data = f"{self._run(run_date)}/data"
        # A file or a few per month, not one per month and task: every later run opens them all.
        rows = rows.select("SalesID", *FACT_COLUMNS, "yearmonth").hint("rebalance", "yearmonth")
        replace_folder(rows, data, ["yearmonth"])

        changes = placed.select(*CHANGE_COLUMNS, F.lit(1).alias("Sign"))
        if again:
            gone = affected.select(*CHANGE_COLUMNS).join(ids, "OrderID", "left_semi")
            changes = changes.unionByName(gone.withColumn("Sign", F.lit(-1)))
        replace_folder(changes, f"{self._run(run_date)}/changes")

        index = self._write_index(placed, stored, touched_buckets, run_date)
        written = self._partitions(data, "yearmonth")
        gone_months = touched | (set(before["months"]) if whole else set())
        months = {month: run for month, run in stored["months"].items() if month not in touched}
        months |= dict.fromkeys(written, str(run_date))
        manifest = {"months": months, "touched": sorted(gone_months), "next_id": stored["next_id"] + fresh}
        self._finish(run_date, manifest | {"index": index, "buckets": stored["buckets"], "whole": whole})
        storage.remove(self.spark, f"{self._run(run_date)}/_placed")

    def _place(self, incoming: DataFrame, run_date: datetime.date, next_id: int) -> tuple[DataFrame, int, int]:
        """The orders of the day with their ids and months, how many are new, and how many not."""
        counts, path = Observation(f"orders {run_date}"), self._run(run_date)
        rows, is_new = incoming.withColumn("yearmonth", year_month("OrderDate")), F.col("SalesID").isNull()
        observed = rows.observe(counts, F.count_if(is_new).alias("fresh"), F.count_if(~is_new).alias("again"))
        replace_folder(observed, f"{path}/_staged")
        staged = self.spark.read.schema(rows.schema).parquet(f"{path}/_staged")
        fresh = staged.where("SalesID IS NULL").drop("SalesID")
        numbered = with_surrogate_key(fresh, "SalesID", order_by="OrderID", start=next_id)
        replace_folder(staged.where("SalesID IS NOT NULL").unionByName(numbered), f"{path}/_placed")
        placed = self.spark.read.schema(staged.schema).parquet(f"{path}/_placed")
        storage.remove(self.spark, f"{path}/_staged")
        return placed, counts.get["fresh"], counts.get["again"]

    def _candidates(self, slots: order_index.SlotFilter, manifest: Mapping[str, Any]) -> tuple[DataFrame, set[int]]:
        """Index rows that can be among some orders, and the buckets that these fall into."""
        if manifest.get("index") is None:
            # Runs from before there was an index: its rows come from the fact, for all buckets.
            found = order_index.entries(self._load(manifest["months"]))
            return found, set(range(manifest["buckets"]))
        buckets = slots.buckets(manifest["buckets"])
        found = self._load_index({key: run for key, run in manifest["index"].items() if int(key) in buckets})
        return found.where(slots.may_have()), buckets

    def _write_index(
        self, placed: DataFrame, stored: Mapping[str, Any], buckets: set[int], run_date: datetime.date
    ) -> dict[str, str]:
        """Write the touched buckets anew; returns the run that wrote each bucket last."""
        known = stored["index"]
        if known is None:
            old, known = order_index.entries(self._load(stored["months"])), {}
        else:
            old = self._load_index({key: run for key, run in known.items() if int(key) in buckets})
        own = placed.select(*order_index.COLUMNS)
        rows = old.join(own.select("OrderID"), "OrderID", "left_anti").unionByName(own)
        path = f"{self._run(run_date)}/index"
        replace_folder(order_index.bucketed(rows, stored["buckets"]), path, ["bucket"])
        return known | dict.fromkeys(self._partitions(path, "bucket"), str(run_date))

    def _partitions(self, path: str, column: str) -> list[str]:
        fields = (name.partition("=") for name in storage.child_names(self.spark, path))
        return [value for key, _, value in fields if key == column]

    def _load(self, months: Mapping[str, str]) -> DataFrame:
        folders = [f"{self._run(run)}/data/yearmonth={month}" for month, run in sorted(months.items())]
        return self._read(folders, self.schema)

    def _load_index(self, buckets: Mapping[str, str]) -> DataFrame:
        return self._read([f"{self._run(run)}/index/bucket={key}" for key, run in sorted(buckets.items())], self.index_schema)

    def _read(self, folders: Iterable[str], schema: StructType | str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)
