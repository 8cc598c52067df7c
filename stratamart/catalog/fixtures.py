"""Inputs of the registered queries, all derived from the star tables."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators import conform, scd2_apply, scd2_bootstrap
from ..operators.dimensions import versioned_input
from ..schemas import RAW_COLUMNS, RAW_FEED, VERSIONED_DIMENSIONS
from ..sinks.tables import write_parquet
from ..sources import retail_feed

# Before the first order.
START = datetime.date(1992, 1, 1)
FIRST_DAY = datetime.date(1998, 1, 1)
SECOND_DAY = datetime.date(1998, 6, 1)

KEYS = ["CustomerID"]
ATTRIBUTES = ["CustomerName", "Segment"]

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(retail_feed(spark, sf_dir))


def stored(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """The rows as read back from a table, for queries that use them more than once."""
    write_parquet(rows, rows.write, path)
    return spark.read.parquet(path)


def existing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A versioned customer table: four of five customers, some with an older version."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 5 <> 0")
    current = customers.selectExpr(
        "c_custkey AS CustomerID",
        "c_name AS CustomerName",
        "c_mktsegment AS Segment",
        "date '1996-01-01' AS valid_from",
        "cast(null AS date) AS valid_to",
        "true AS is_current",
    )
    older = customers.where("c_custkey % 4 = 0").selectExpr(
        "c_custkey AS CustomerID",
        "concat('Old ', c_name) AS CustomerName",
        "c_mktsegment AS Segment",
        "date '1995-01-01' AS valid_from",
        "date '1996-01-01' AS valid_to",
        "false AS is_current",
    )
    return current.unionByName(older)


def incoming_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed, nulled, moved and new customers; one of seven known ones does not come in."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    customers = customers.where("c_custkey % 7 <> 0 OR c_custkey % 5 = 0")
    return customers.selectExpr(
        "c_custkey AS CustomerID",
        """CASE WHEN c_custkey % 3 = 0 THEN concat(c_name, ' Jr')
                WHEN c_custkey % 11 = 0 THEN null ELSE c_name END AS CustomerName""",
        "CASE WHEN c_custkey % 10 = 1 THEN 'RETAIL' ELSE c_mktsegment END AS Segment",
    )


def dimension_days(
    rows: DataFrame, keys: list[str], attributes: list[str]
) -> tuple[DataFrame, DataFrame]:
    """A dimension as seen by the orders before the first day, and by those after it.

    On the second day the first attribute of every ninth key has a new value.
    """
    before = versioned_input(rows.where(F.col("OrderDate") < F.lit(FIRST_DAY)), keys, attributes)
    after = versioned_input(rows.where(F.col("OrderDate") >= F.lit(FIRST_DAY)), keys, attributes)
    name = F.col(attributes[0])
    number = F.substring(keys[0], 2, 20).cast("bigint")
    renamed = F.when(number % 9 == 0, F.concat(name, F.lit(" v2"))).otherwise(name)
    return before, after.withColumn(attributes[0], renamed)


def write_malformed(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Feed files in which every row is malformed: an order as 3 fields, a supplier as 20."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    too_short = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")]
    too_long = [F.col("s_suppkey"), *[F.lit("surplus")] * 19]
    header = ",".join(RAW_COLUMNS)
    lines = orders.select(F.concat_ws(",", *too_short).alias(header)).unionByName(
        suppliers.select(F.concat_ws(",", *too_long).alias(header))
    )
    # A tab as separator lets whole lines, header included, pass unquoted.
    lines.write.option("header", True).option("sep", "\t").csv(path)


def write_uneven(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Feed files with rows of 3 fields (orders) and of 15, two of them surplus (suppliers)."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    too_short = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")]
    values = {"OrderID": F.col("s_suppkey"), "TotalPrice": F.col("s_acctbal")}
    too_long = [values.get(name, F.lit(name)) for name in RAW_COLUMNS] + [F.lit("surplus")] * 2
    header = ",".join(RAW_COLUMNS)
    lines = orders.select(F.concat_ws(",", *too_short).alias(header)).unionByName(
        suppliers.select(F.concat_ws(",", *too_long).alias(header))
    )
    lines.write.option("header", True).option("sep", "\t").csv(path)


def store_versions(rows: DataFrame) -> DataFrame:
    """Stores as known before the first day and after it, when every ninth has moved."""
    keys, attributes = VERSIONED_DIMENSIONS["store"]
    before, after = dimension_days(rows, keys, attributes)
    known = scd2_bootstrap(before, START)
    return scd2_apply(known, after, keys, attributes, FIRST_DAY)


def write_feed(rows: DataFrame, path: str, *partition_by: str) -> None:
    """Feed files with their header, compressed as fast as may be: their text is many times the tables."""
    writer = rows.write.option("header", True).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    with storage.shuffles_end_with_job(rows.sparkSession):
        writer.partitionBy(*partition_by).csv(path)


class Extracts:
    """The feed as extracts of which each has the orders with another remainder, all made in one pass.

    Their files wait beside ``landing``, in which ``land`` puts those of one extract.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str, count: int):
        self.spark, self.waiting = spark, f"{folder}/extracts"
        dealt = retail_feed(spark, sf_dir).withColumn("extract", order_number() % count)
        # A task keeps a file open for each extract, so its rows need no sorting.
        before = spark.conf.get(WRITERS, None)
        spark.conf.set(WRITERS, str(count + 1))
        try:
            write_feed(dealt, self.waiting, "extract")
        finally:
            if before is None:
                spark.conf.unset(WRITERS)
            else:
                spark.conf.set(WRITERS, before)

    def land(self, number: int, landing: str) -> None:
        names = storage.child_names(self.spark, f"{self.waiting}/extract={number}")
        for name in names:
            storage.move(self.spark, f"{self.waiting}/extract={number}/{name}", f"{landing}/{number}-{name}")
        if not names:
            none = self.spark.createDataFrame([], RAW_FEED)
            none.write.mode("append").option("header", True).csv(landing)


def order_number() -> Column:
    """The digits of a raw order id, readable or not."""
    return F.regexp_extract("OrderID", "[0-9]+", 0).cast("bigint")
