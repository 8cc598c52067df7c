"""The registered queries: callables of a session and a folder of star tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from ..operators import versions
from ..operators.conform import deduplicate
from ..plans.daily import (
    PLAIN_DIMENSIONS,
    Warehouse,
    read_rejects,
    run_daily,
    star_schema,
)
from ..plans.measures import monthly_kpi, regional_sales_trend
from ..schemas import FACT_COLUMNS, RAW_FEED, VERSIONED_DIMENSIONS
from ..sinks import (
    EvolvingTable,
    FactStore,
    KpiStore,
    VersionStore,
    append_months,
    append_run,
    publish,
    read_published,
    replace_months,
    replace_run,
    replace_runs,
)
from ..sinks.tables import union_evolved
from ..sources import (
    read_evolving,
    malformed,
    read_feed,
    read_feed_audited,
    read_feed_inferred,
    read_run,
    retail_feed,
    table_exists,
)
from ..storage import shared_folder
from ..streaming import ingest_available, read_bronze, read_malformed
from .fixtures import (
    ATTRIBUTES,
    FIRST_DAY,
    KEYS,
    SECOND_DAY,
    Extracts,
    clean,
    dimension_days,
    existing_customers,
    incoming_customers,
    order_number,
    store_versions,
    stored,
    write_feed,
    write_malformed,
    write_uneven,
)

# The columns of the stored monthly measures.
KPI_COLUMNS = """TotalRevenue double, TotalOrders bigint, AverageOrderValue double,
    UniqueCustomers bigint, yearmonth string"""

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def _run_day() -> Column:
    """The run in which an order came in: the second one for orders from its start on."""
    is_later = F.col("OrderDate") >= F.lit(FIRST_DAY)
    return F.when(is_later, F.lit(SECOND_DAY)).otherwise(F.lit(FIRST_DAY))


# Sources


@query
def bronze_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "bronze_csv_scan")
    retail_feed(spark, sf_dir).write.option("header", True).csv(f"{folder}/good")
    write_malformed(spark, sf_dir, f"{folder}/malformed")
    return read_feed(spark, [f"{folder}/good", f"{folder}/malformed"])


@query
def bronze_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "bronze_csv_infer")
    retail_feed(spark, sf_dir).write.option("header", True).csv(f"{folder}/even")
    write_uneven(spark, sf_dir, f"{folder}/uneven")
    return read_feed_inferred(spark, [f"{folder}/even", f"{folder}/uneven"])


def _folder_name() -> Column:
    """The folder of a line's file, which unlike its path is the same on every run."""
    return F.element_at(F.split("SourceFile", "/"), -2).alias("Folder")


@query
def bronze_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of three folders that are no rows of the feed, with the reason."""
    folder = shared_folder(spark, "bronze_malformed")
    retail_feed(spark, sf_dir).write.option("header", True).csv(f"{folder}/good")
    write_malformed(spark, sf_dir, f"{folder}/malformed")
    write_uneven(spark, sf_dir, f"{folder}/uneven")
    lines = read_feed_audited(spark, [f"{folder}/{name}" for name in ("good", "malformed", "uneven")])
    return malformed(lines, len(RAW_FEED)).select("MalformedLine", "Fields", "Reason", _folder_name())


@query
def stream_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows and malformed lines two runs of the stream have taken over, by folder and reason."""
    folder = shared_folder(spark, "stream_malformed")
    feed = stored(spark, retail_feed(spark, sf_dir), f"{folder}/feed")
    paths = (f"{folder}/landing", f"{folder}/bronze", f"{folder}/checkpoint")
    feed.where(order_number() % 2 == 0).write.option("header", True).csv(f"{paths[0]}/good")
    write_malformed(spark, sf_dir, f"{paths[0]}/malformed")
    ingest_available(spark, f"{paths[0]}/*", *paths[1:], FIRST_DAY)
    feed.where(order_number() % 2 == 1).write.mode("append").option("header", True).csv(f"{paths[0]}/good")
    ingest_available(spark, f"{paths[0]}/*", *paths[1:], SECOND_DAY)
    rows = read_bronze(spark, paths[1]).select(F.lit("good").alias("Folder"), F.lit(None).cast("string").alias("Reason"))
    lines = rows.unionByName(read_malformed(spark, paths[1]).select(_folder_name(), "Reason"))
    return lines.groupBy("Folder", "Reason").agg(F.count(F.lit(1)).alias("Lines"))


@query
def silver_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "silver_partition_scan")
    replace_runs(clean(spark, sf_dir).withColumn("run_date", _run_day()), folder)
    return read_run(spark, folder, SECOND_DAY)


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream_ingest")
    feed = stored(spark, retail_feed(spark, sf_dir), f"{folder}/feed")
    for drop in range(3):
        part = feed.where(F.pmod(F.xxhash64("OrderID"), F.lit(3)) == drop)
        part.write.mode("append").option("header", True).csv(f"{folder}/landing")
        ingest_available(
            spark,
            f"{folder}/landing",
            f"{folder}/bronze",
            f"{folder}/checkpoint",
            SECOND_DAY,
            archive=f"{folder}/archive",
        )
    return read_bronze(spark, f"{folder}/bronze", SECOND_DAY)


@query
def ingest_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies in the archive after each of four runs took a quarter of the orders.

    A run that takes new files archives those of the run before it, so the last ones are not there.
    """
    folder = shared_folder(spark, "ingest_archive")
    feed = stored(spark, retail_feed(spark, sf_dir), f"{folder}/feed")
    for drop in range(4):
        extract = feed.where(order_number() % 4 == drop)
        extract.write.mode("append").option("header", True).csv(f"{folder}/landing")
        ingest_available(
            spark,
            f"{folder}/landing",
            f"{folder}/bronze",
            f"{folder}/checkpoint",
            SECOND_DAY,
            archive=f"{folder}/archive",
        )
    return read_feed(spark, f"{folder}/archive", recursive=True)


# Silver


@query
def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_date_text(ops.type_rows(retail_feed(spark, sf_dir)))


@query
def silver_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = ops.type_rows(retail_feed(spark, sf_dir))
    return ops.with_date_text(deduplicate(typed))


@query
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir)


@query
def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.quarantine(retail_feed(spark, sf_dir))


# Star schema


@query
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dimension(clean(spark, sf_dir), "CustomerID", ["CustomerName"])


@query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dimension(clean(spark, sf_dir), "ProductID", ["ProductName"])


@query
def dim_product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dimension(clean(spark, sf_dir), "ProductID", ["ProductName", "Category"])


@query
def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dimension(clean(spark, sf_dir), "StoreID", ["StoreLocation"])


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.date_dimension(clean(spark, sf_dir), "OrderDate")


@query
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.sales_fact(clean(spark, sf_dir))


@query
def fact_yearmonth(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = clean(spark, sf_dir).select(*FACT_COLUMNS)
    return ops.with_year_month(fact).select("OrderDate", "yearmonth")


# Measures


@query
def kpi_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = clean(spark, sf_dir).select(*FACT_COLUMNS)
    return monthly_kpi(fact, one_row_per_order=True)


@query
def kpi_monthly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of all lines with a date and a price, whose orders repeat."""
    lines = ops.type_rows(retail_feed(spark, sf_dir))
    return monthly_kpi(lines.where("OrderDate IS NOT NULL AND TotalPrice IS NOT NULL"))


@query
def regional_sales_trend_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by where their store was, every ninth store having moved on the first day."""
    rows = clean(spark, sf_dir)
    return regional_sales_trend(rows.select(*FACT_COLUMNS), store_versions(rows))


# Sinks


@query
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "sink_append")
    rows = ops.with_date_text(ops.type_rows(retail_feed(spark, sf_dir)))
    append_run(rows.where(F.col("OrderDate").isNull()), folder, FIRST_DAY)
    append_run(rows.where(F.col("OrderDate").isNotNull()), folder, FIRST_DAY)
    return read_run(spark, folder, FIRST_DAY)


@query
def sink_overwrite_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two run days of typed rows, the second of which is then replaced by its clean rows."""
    folder = shared_folder(spark, "sink_overwrite_partition")
    raw = retail_feed(spark, sf_dir)
    typed = ops.with_date_text(ops.type_rows(raw))
    replace_runs(typed.withColumn("run_date", _run_day()), folder)
    later = ops.conform(raw).where(F.col("OrderDate") >= F.lit(FIRST_DAY))
    replace_run(later, folder, SECOND_DAY)
    return spark.read.parquet(folder)


@query
def sink_overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star joined from its published tables, after each of them was replaced once."""
    folder = shared_folder(spark, "sink_overwrite_table")
    suffix = folder.rsplit("-", 1)[1]
    replace_run(clean(spark, sf_dir), f"{folder}/silver", SECOND_DAY)
    silver = read_run(spark, f"{folder}/silver", SECOND_DAY).drop("run_date")
    for rows in (silver.where(F.col("OrderDate") < F.lit(FIRST_DAY)), silver):
        for name, table in star_schema(rows).items():
            publish(table, f"{folder}/{name}", table=f"{name}_{suffix}")

    def dimension(name: str, key: str) -> DataFrame:
        # Distinct rows can have a key twice; a sale is to meet it once.
        return ops.one_row_per_key(spark.table(f"{name}_{suffix}"), [key])

    dates = spark.table(f"dim_date_{suffix}").withColumnRenamed("OrderDateParsed", "OrderDate")
    star = (
        spark.table(f"fact_sales_{suffix}")
        .join(dimension("dim_customer", "CustomerID"), "CustomerID")
        .join(dimension("dim_product", "ProductID"), "ProductID")
        .join(dimension("dim_store", "StoreID"), "StoreID")
        .join(dates, "OrderDate")
    )
    # The files stay; only the names go, which the plan no longer needs.
    for name in (*PLAIN_DIMENSIONS, "dim_date", "fact_sales"):
        spark.sql(f"DROP TABLE {name}_{suffix}")
    return star


@query
def table_exists_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which tables are found after the dimensions of the earlier orders were published."""
    folder = shared_folder(spark, "table_exists")
    rows = stored(spark, clean(spark, sf_dir), f"{folder}/silver")
    tables = star_schema(rows.where(F.col("OrderDate") < F.lit(FIRST_DAY)))
    sizes = []
    for name, table in tables.items():
        if name.startswith("dim_"):
            publish(table, f"{folder}/{name}")
        found = table_exists(spark, f"{folder}/{name}")
        count = F.count(F.lit(1)).alias("Rows")
        size = read_published(spark, f"{folder}/{name}") if found else rows.limit(0)
        sizes.append(size.agg(count).select(F.lit(name).alias("Name"), F.lit(found).alias("Found"), "Rows"))
    return reduce(DataFrame.unionByName, sizes)


@query
def sink_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "sink_schema_merge")
    rows = stored(spark, clean(spark, sf_dir), f"{folder}/silver")
    narrow = ops.dimension(rows, "ProductID", ["ProductName"])
    replace_run(narrow, f"{folder}/products", FIRST_DAY)
    wider = ops.dimension(rows, "ProductID", ["ProductName", "Category"])
    replace_run(wider, f"{folder}/products", SECOND_DAY)
    return read_evolving(spark, f"{folder}/products")


@query
def sink_schema_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of two runs, the later with one more column; one with another type is refused."""
    table = EvolvingTable(spark, shared_folder(spark, "sink_schema_log"))
    rows = stored(spark, clean(spark, sf_dir), f"{table.path}-silver")
    table.write(ops.dimension(rows, "ProductID", ["ProductName"]), FIRST_DAY)
    wider = ops.dimension(rows, "ProductID", ["ProductName", "Category"])
    table.write(wider, SECOND_DAY)
    try:
        table.write(wider.withColumn("Category", F.length("Category")), SECOND_DAY + datetime.timedelta(days=1))
    except ValueError:
        return table.read()
    raise AssertionError("a changed type was written")


@query
def union_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean(spark, sf_dir)
    narrow = ops.dimension(rows, "ProductID", ["ProductName"])
    return union_evolved(narrow, ops.dimension(rows, "ProductID", ["ProductName", "Category"]))


@query
def kpi_upsert_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months written up to a day inside one, then that month and the later ones as a whole."""
    folder = shared_folder(spark, "kpi_upsert_month")
    fact = stored(spark, clean(spark, sf_dir).select(*FACT_COLUMNS), f"{folder}/fact")
    until_inside = fact.where(F.col("OrderDate") <= F.lit(FIRST_DAY + datetime.timedelta(days=14)))
    later = fact.where(F.col("OrderDate") >= F.lit(FIRST_DAY))
    for sales in (until_inside, later):
        replace_months(monthly_kpi(sales, one_row_per_order=True), f"{folder}/kpi")
    return spark.read.schema(KPI_COLUMNS).parquet(f"{folder}/kpi")


@query
def kpi_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months added by two loads, the second of which is repeated and so counts twice."""
    folder = shared_folder(spark, "kpi_append")
    fact = stored(spark, clean(spark, sf_dir).select(*FACT_COLUMNS), f"{folder}/fact")
    is_later = F.col("OrderDate") >= F.lit(FIRST_DAY)
    for sales in (fact.where(~is_later), fact.where(is_later), fact.where(is_later)):
        append_months(monthly_kpi(sales, one_row_per_order=True), f"{folder}/kpi")
    return spark.read.schema(KPI_COLUMNS).parquet(f"{folder}/kpi")


@query
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly measures after feed files went through the whole day twice."""
    folder = shared_folder(spark, "daily_run")
    write_feed(retail_feed(spark, sf_dir), f"{folder}/landing")
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/warehouse")
    for _ in range(2):
        run_daily(spark, warehouse, SECOND_DAY)
    return warehouse.snapshot(spark, "monthly_kpi").read()


def _two_extracts(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse after two daily runs, each with half of the orders of every month."""
    folder = shared_folder(spark, "two_extracts")
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/warehouse")
    extracts = Extracts(spark, sf_dir, folder, 2)
    for number, day in enumerate((FIRST_DAY, SECOND_DAY)):
        extracts.land(number, warehouse.landing)
        run_daily(spark, warehouse, day)
    return warehouse


@query
def daily_two_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_extracts(spark, sf_dir).snapshot(spark, "monthly_kpi").read()


@query
def daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_extracts(spark, sf_dir).fact(spark).read()


@query
def daily_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the three dimensions, keys and attributes side by side."""
    warehouse = _two_extracts(spark, sf_dir)
    versions_of = (warehouse.versions(spark, name).read() for name in VERSIONED_DIMENSIONS)
    return reduce(union_evolved, versions_of)


@query
def daily_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _two_extracts(spark, sf_dir)
    days = (read_rejects(spark, warehouse.silver, day) for day in (FIRST_DAY, SECOND_DAY))
    return reduce(DataFrame.unionByName, days)


@query
def daily_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain dimensions of both extracts, side by side."""
    warehouse = _two_extracts(spark, sf_dir)
    names = (*PLAIN_DIMENSIONS, "dim_date")
    return reduce(union_evolved, (warehouse.snapshot(spark, name).read() for name in names))


@query
def daily_after_lost_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after three days with a third of the orders each.

    The second day dies when its files are taken over and is not repeated; the third makes it up.
    """
    folder = shared_folder(spark, "daily_after_lost_day")
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/warehouse")
    extracts = Extracts(spark, sf_dir, folder, 3)
    for number, day in enumerate((FIRST_DAY, FIRST_DAY + datetime.timedelta(days=1), SECOND_DAY)):
        extracts.land(number, warehouse.landing)
        if number == 1:
            ingest_available(spark, warehouse.landing, warehouse.bronze, warehouse.checkpoint, day)
        else:
            run_daily(spark, warehouse, day)
    return warehouse.fact(spark).read()


def _corrected_fact(spark: SparkSession, folder: str, rows: DataFrame) -> FactStore:
    """A fact in which every fifth order moved on by 40 days, and every third one is new."""
    fact = FactStore(spark, f"{folder}/fact")
    number = F.col("OrderID")
    earlier = F.when(number % 5 == 0, F.date_sub("OrderDate", 40)).otherwise(F.col("OrderDate"))
    other = F.when(number % 5 == 0, F.lit("C0")).otherwise(F.col("CustomerID"))
    first = rows.where(number % 3 != 0).withColumns({"OrderDate": earlier, "CustomerID": other})
    fact.upsert(first, FIRST_DAY)
    fact.upsert(rows.where((number % 3 == 0) | (number % 5 == 0)), SECOND_DAY)
    return fact


@query
def fact_order_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each order is after some have moved to other months."""
    folder = shared_folder(spark, "fact_order_index")
    rows = stored(spark, clean(spark, sf_dir), f"{folder}/silver")
    return _corrected_fact(spark, folder, rows).read_index()


@query
def kpi_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly measures, kept up by what was added to the fact and taken out of it."""
    folder = shared_folder(spark, "kpi_incremental")
    rows = stored(spark, clean(spark, sf_dir), f"{folder}/silver")
    fact, measures = _corrected_fact(spark, folder, rows), KpiStore(spark, f"{folder}/kpi")
    for day in fact.runs():
        measures.apply(fact.read_changes(day), day)
    return measures.read()


# Versioned dimensions


def _tagged(spark: SparkSession, sf_dir: str, null_safe: bool = True) -> DataFrame:
    return ops.scd2_tagged(
        existing_customers(spark, sf_dir),
        incoming_customers(spark, sf_dir),
        KEYS,
        ATTRIBUTES,
        SECOND_DAY,
        null_safe,
    )


def _by_change(change: str) -> Query:
    def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _tagged(spark, sf_dir).where(F.col("change") == change).drop("change")

    return rows


QUERIES["scd2_expired"] = _by_change(versions.EXPIRED)
QUERIES["scd2_new_versions"] = _by_change(versions.NEW_VERSION)
QUERIES["scd2_new_keys"] = _by_change(versions.NEW_KEY)
QUERIES["scd2_unchanged"] = _by_change(versions.UNCHANGED)
QUERIES["scd2_history"] = _by_change(versions.HISTORY)


@query
def scd2_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "scd2_bootstrap")
    if table_exists(spark, folder):
        raise ValueError(f"{folder} is not a fresh folder")
    store = VersionStore(spark, folder)
    store.apply(incoming_customers(spark, sf_dir), KEYS, ATTRIBUTES, SECOND_DAY)
    return store.read()


@query
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = VersionStore(spark, shared_folder(spark, "scd2_current"))
    store.load(existing_customers(spark, sf_dir), FIRST_DAY, KEYS)
    store.apply(incoming_customers(spark, sf_dir), KEYS, ATTRIBUTES, SECOND_DAY)
    return store.current()


@query
def scd2_store_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table after its second day was run twice."""
    store = VersionStore(spark, shared_folder(spark, "scd2_store_replay"))
    store.load(existing_customers(spark, sf_dir), FIRST_DAY, KEYS)
    for _ in range(2):
        store.apply(incoming_customers(spark, sf_dir), KEYS, ATTRIBUTES, SECOND_DAY)
    return store.read()


@query
def scd2_store_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table after a second day that came in over two runs, with many buckets."""
    store = VersionStore(spark, shared_folder(spark, "scd2_store_buckets"), buckets=128)
    store.load(existing_customers(spark, sf_dir), FIRST_DAY, KEYS)
    incoming = incoming_customers(spark, sf_dir)
    store.apply(incoming.where("CustomerID % 2 = 0"), KEYS, ATTRIBUTES, FIRST_DAY + datetime.timedelta(days=1))
    store.apply(incoming.where("CustomerID % 2 = 1"), KEYS, ATTRIBUTES, SECOND_DAY)
    return store.read()


@query
def scd2_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, incoming = existing_customers(spark, sf_dir), incoming_customers(spark, sf_dir)
    return ops.scd2_changed(existing, incoming, KEYS, ATTRIBUTES, null_safe=False)


@query
def scd2_changed_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, incoming = existing_customers(spark, sf_dir), incoming_customers(spark, sf_dir)
    return ops.scd2_changed(existing, incoming, KEYS, ATTRIBUTES)


@query
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).drop("change")


@query
def scd2_apply_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir, null_safe=False).drop("change")


@query
def scd2_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.scd2_metrics(_tagged(spark, sf_dir))


@query
def scd2_current_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_apply(spark, sf_dir).where("is_current").orderBy("CustomerID").limit(10)


@query
def scd2_history_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest_first = F.col("valid_from").desc()
    return scd2_apply(spark, sf_dir).orderBy("CustomerID", newest_first).limit(20)


def _two_days(rows: DataFrame, name: str) -> DataFrame:
    keys, attributes = VERSIONED_DIMENSIONS[name]
    before, after = dimension_days(rows, keys, attributes)
    existing = ops.scd2_bootstrap(before, FIRST_DAY)
    return ops.scd2_apply(existing, after, keys, attributes, SECOND_DAY)


@query
def scd2_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_days(clean(spark, sf_dir), "customer")


@query
def scd2_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_days(clean(spark, sf_dir), "product")


@query
def scd2_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_days(clean(spark, sf_dir), "store")


@query
def scd2_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units per store and product as they stood on either day."""
    keys, rows = ["StoreID", "ProductID"], clean(spark, sf_dir)

    def units(condition) -> DataFrame:
        return rows.where(condition).groupBy(*keys).agg(F.sum("Quantity").alias("Units"))

    existing = ops.scd2_bootstrap(units(F.col("OrderDate") < F.lit(FIRST_DAY)), FIRST_DAY)
    incoming = units(F.col("OrderDate") >= F.lit(FIRST_DAY))
    return ops.scd2_apply(existing, incoming, keys, ["Units"], SECOND_DAY)


@query
def scd2_from_history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units ordered per store and product as they stood after each day, built at once."""
    keys, rows = ["StoreID", "ProductID"], clean(spark, sf_dir)
    daily = rows.groupBy(*keys, "OrderDate").agg(F.sum("Quantity").alias("Units"))
    return ops.scd2_from_history(daily, keys, ["Units"], "OrderDate")


@query
def scd_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose names are corrected everywhere and whose segments have history."""
    existing, incoming = existing_customers(spark, sf_dir), incoming_customers(spark, sf_dir)
    return ops.scd_mixed_apply(existing, incoming, KEYS, ["CustomerName"], ["Segment"], SECOND_DAY)


@query
def scd2_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "scd2_summary")
    rows = stored(spark, clean(spark, sf_dir), folder)
    customer, product, store = (
        ops.scd2_summary(_two_days(rows, name), name) for name in VERSIONED_DIMENSIONS
    )
    return customer.unionByName(product).unionByName(store)


@query
def scd1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = existing_customers(spark, sf_dir).where("is_current")
    return ops.scd1_upsert(current, incoming_customers(spark, sf_dir), KEYS, ATTRIBUTES)


def _orders_with_versions(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )
    join = how.pop("join", ops.as_of_join)
    return join(
        orders,
        scd2_apply(spark, sf_dir),
        keys={"o_custkey": "CustomerID"},
        date_column="o_orderdate",
        columns=[*ATTRIBUTES, "valid_from"],
        **how,
    ).drop("o_orderdate")


@query
def asof_fact_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_versions(spark, sf_dir)


@query
def asof_fact_dim_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_versions(spark, sf_dir, splits=8)


@query
def asof_fact_dim_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_versions(spark, sf_dir, by_month=True)


@query
def asof_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_versions(spark, sf_dir, join=ops.as_of_carry_forward)
