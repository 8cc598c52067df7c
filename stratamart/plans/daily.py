"""The daily run: feed files to bronze, silver, star schema, measures and history."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import none_null
from ..operators import date_dimension, dimension, judge, sales_fact
from ..operators.conform import RAW_KEY
from ..operators.dimensions import attribute_sets, newest_attributes
from ..schemas import VERSIONED_DIMENSIONS
from ..sinks import BatchLedger, FactStore, KpiStore, SnapshotStore, VersionStore, replace_run
from ..sinks.runs import DAY, RunFolders
from ..sources import read_run
from ..streaming import bronze_batches, bronze_days, has_bronze, ingest_available, read_bronze

# The plain dimensions that show columns of the versioned ones.
PLAIN_DIMENSIONS = {
    "dim_customer": ("customer", ["CustomerID", "CustomerName"]),
    "dim_product": ("product", ["ProductID", "ProductName"]),
    "dim_store": ("store", ["StoreID", "StoreLocation"]),
}


@dataclass(frozen=True)
class Warehouse:
    """Where things are. All paths have to be reachable from every executor.

    The files of a day are one extract. By default an extract has the orders that are new or
    have changed, and the warehouse accumulates them; with ``whole_extracts`` each one is the
    whole feed and takes the place of what was there. Versioned dimensions have history in
    either case.
    """

    landing: str
    root: str
    archive: str | None = None
    id_type: str = "bigint"
    whole_extracts: bool = False

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def fact(self, spark: SparkSession) -> FactStore:
        return FactStore(spark, self.gold("fact_sales"), self.id_type)

    def measures(self, spark: SparkSession) -> KpiStore:
        """What ``monthly_kpi`` is made from."""
        return KpiStore(spark, self.gold("kpi_state"))

    def ledger(self, spark: SparkSession) -> BatchLedger:
        return BatchLedger(spark, f"{self.root}/ledger")

    def snapshot(self, spark: SparkSession, table: str) -> SnapshotStore:
        """The store of a plain dimension or of ``monthly_kpi``."""
        return SnapshotStore(spark, self.gold(table))

    def versions(self, spark: SparkSession, name: str) -> VersionStore:
        return VersionStore(spark, self.gold(f"dim_{name}_scd2"))

    def stores(self, spark: SparkSession) -> list[RunFolders]:
        """The stores of all gold tables."""
        small = [self.snapshot(spark, name) for name in [*PLAIN_DIMENSIONS, "dim_date", "monthly_kpi"]]
        return [self.fact(spark), self.measures(spark), *small, *(self.versions(spark, name) for name in VERSIONED_DIMENSIONS)]


def star_schema(silver: DataFrame) -> dict[str, DataFrame]:
    """The four dimensions and the fact of one silver table."""
    return {
        "dim_customer": dimension(silver, "CustomerID", ["CustomerName"]),
        "dim_product": dimension(silver, "ProductID", ["ProductName"]),
        "dim_store": dimension(silver, "StoreID", ["StoreLocation"]),
        "dim_date": date_dimension(silver, "OrderDate"),
        "fact_sales": sales_fact(silver),
    }


def write_silver(judged: DataFrame, path: str, run_date: datetime.date) -> dict[str, dict[str, int]]:
    """Accepted and rejected rows of a day in one table, told apart by ``failed_rule``.

    Returns how many there are of each, and how many accepted rows lack a key of a versioned
    dimension, all counted while they are written.
    """
    accepted = F.col("failed_rule").isNull()
    missing = {
        name: F.count_if(accepted & ~none_null(keys)).alias(name)
        for name, (keys, _) in VERSIONED_DIMENSIONS.items()
    }
    counts = Observation(f"silver {run_date}")
    observed = judged.observe(
        counts,
        F.count_if(accepted).alias("Accepted"),
        F.count_if(~accepted).alias("Rejected"),
        *missing.values(),
    )
    replace_run(observed, path, run_date)
    found = counts.get
    return {
        "silver": {name: found[name] for name in ("Accepted", "Rejected")},
        "null keys": {name: found[name] for name in missing},
    }


def read_silver(spark: SparkSession, path: str, run_date: datetime.date) -> DataFrame:
    rows = read_run(spark, path, run_date).where("failed_rule IS NULL")
    return rows.drop("run_date", "failed_rule", RAW_KEY)


def read_rejects(spark: SparkSession, path: str, run_date: datetime.date) -> DataFrame:
    """The rejected rows of a day with their rule and the order id as text."""
    rows = read_run(spark, path, run_date).where("failed_rule IS NOT NULL").drop("run_date")
    return rows.withColumn(RAW_KEY, F.coalesce(RAW_KEY, F.col("OrderID").cast("string")))


def run_daily(
    spark: SparkSession, warehouse: Warehouse, run_date: datetime.date, replay: bool = False
) -> dict[str, dict[str, int]]:
    """Run every step for one day; repeating the last day leaves the same tables.

    A day whose run died before all its tables were finished is made up first, whether or not it
    was repeated by itself: the ledger, written last, has no entry for it. Made-up days are run
    one after another as the days they are, so the tables are those of a warehouse in which
    nothing died.

    A day before the last one is refused before anything is touched, unless ``replay`` is set;
    the days after it then have no entry either, and are repeated by the next run, if not before.
    Returns the counts of silver and of each versioned dimension, and the accepted and rejected
    rows of days made up. A day without feed rows leaves the gold tables as they are.
    """
    ledger, stores = warehouse.ledger(spark), warehouse.stores(spark)
    for store in (ledger, *stores):
        store.check_order(run_date, replay)
    # From here on the day counts as unfinished.
    ledger.reopen(run_date)
    ingest_available(
        spark,
        warehouse.landing,
        warehouse.bronze,
        warehouse.checkpoint,
        run_date,
        archive=warehouse.archive,
    )
    made_up = {}
    # Making up a day takes back the entries of the days after it, so these are asked for anew.
    while lost := ledger.unfinished(bronze_days(spark, warehouse.bronze), before=run_date):
        day = lost[0]
        later = [last for last in (store.latest() for store in stores) if last and last > day]
        if later and not replay:
            raise ValueError(f"bronze of {day} is not in all tables, some of which have a run of {max(later)}; repeat it with replay")
        made_up[f"made up {day}"] = _run_day(spark, warehouse, day, replay).get("silver", {})
    return _run_day(spark, warehouse, run_date, replay) | made_up


def _run_day(spark: SparkSession, warehouse: Warehouse, run_date: datetime.date, replay: bool) -> dict[str, dict[str, int]]:
    """Bring the bronze of one day into all tables, and enter it in the ledger."""
    fact, kpi = warehouse.fact(spark), warehouse.snapshot(spark, "monthly_kpi")
    plain = {name: warehouse.snapshot(spark, name) for name in [*PLAIN_DIMENSIONS, "dim_date"]}
    batches = bronze_batches(spark, warehouse.bronze, run_date)
    if not has_bronze(spark, warehouse.bronze, run_date):
        if run_date in bronze_days(spark, warehouse.bronze):
            warehouse.ledger(spark).record(run_date, batches)
        return {}
    raw = read_bronze(spark, warehouse.bronze, run_date)
    counts = write_silver(judge(raw, warehouse.id_type), warehouse.silver, run_date)
    null_keys = counts.pop("null keys")
    silver = read_silver(spark, warehouse.silver, run_date)

    fact.upsert(silver, run_date, replay, whole=warehouse.whole_extracts)
    measures = warehouse.measures(spark)
    record_changes(fact, measures, run_date, replay, warehouse.whole_extracts)
    kpi.publish(measures.read(run_date).coalesce(1), run_date, replay)
    dates = date_dimension(silver, "OrderDate")
    accumulate(plain["dim_date"], dates, run_date, replay, warehouse.whole_extracts)
    # One aggregation of silver serves the plain and the versioned form of a dimension.
    sets = {}
    for name, (keys, attributes) in VERSIONED_DIMENSIONS.items():
        folder = f"{warehouse.root}/attributes/{name}"
        replace_run(attribute_sets(silver, keys, attributes, "OrderDate"), folder, run_date)
        sets[name] = read_run(spark, folder, run_date).drop("run_date")
    for name, (source, columns) in PLAIN_DIMENSIONS.items():
        rows = sets[source].select(*columns).distinct()
        accumulate(plain[name], rows, run_date, replay, warehouse.whole_extracts)
    for name, (keys, attributes) in VERSIONED_DIMENSIONS.items():
        incoming = newest_attributes(sets[name], keys, attributes)
        changes = warehouse.versions(spark, name).apply(incoming, keys, attributes, run_date, replay=replay)
        counts[name] = {**changes, "NullKeys": null_keys[name]}
    warehouse.ledger(spark).record(run_date, batches)
    return counts


def accumulate(
    store: SnapshotStore, rows: DataFrame, run_date: datetime.date, replay: bool, whole: bool
) -> None:
    """Add distinct rows to those of the run before, or replace them."""
    previous = store.latest(run_date - DAY)
    if previous is not None and not whole:
        rows = store.read(previous).unionByName(rows).distinct()
    store.publish(rows, run_date, replay)


def record_changes(
    fact: FactStore, measures: KpiStore, run_date: datetime.date, replay: bool, whole: bool
) -> None:
    """Count the orders that a run of the fact has added and taken out."""
    changes = fact.read_changes(run_date)
    if not whole and measures.latest(run_date - DAY) is None and fact.latest(run_date - DAY) is not None:
        # A fact from before there were measures of this kind: all its orders count as added.
        changes, whole = fact.read(run_date).withColumn("Sign", F.lit(1)), True
    measures.apply(changes, run_date, replay, whole)
