"""The raw sales feed, composed from normalised order tables.

The order tables are clean, so defects are put in by key arithmetic: order ids that are unreadable or need
64 bits, unreadable dates, quantities and prices, two date formats, missing customers and zero quantities.
Orders have several lines, so order ids repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS


# The columns of the star tables that the feed is made of.
STAR_COLUMNS = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz,
        o_orderpriority string""",
    "customer": "c_custkey bigint, c_name string",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def retail_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        # With its columns given, a table is not opened before the query runs.
        return spark.read.schema(STAR_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")

    def text(name: str):
        return F.col(name).cast("string")

    # What an order or a product has is put into words once for it, not once for each of its lines.
    # Lines meet stores, products and orders in this order: each shuffle has what the ones before it
    # added, so the widest come last. The lines of an order end up side by side, where a task can
    # reduce them to one before the next shuffle and files hold what they have in common once.
    order = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    orders = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    orders = orders.select(
        "o_orderkey",
        F.when(order % 101 == 0, F.concat(F.lit("X"), text("o_orderkey")))
        .when(order % 103 == 0, (order + 3_000_000_000).cast("string"))
        .otherwise(text("o_orderkey"))
        .alias("OrderID"),
        F.when(order % 97 == 0, F.lit("not-a-date"))
        .when(order % 2 == 0, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "dd-MM-yyyy"))
        .alias("OrderDate"),
        F.when(order % 73 != 0, F.concat(F.lit("C"), text("o_custkey"))).alias("CustomerID"),
        F.col("c_name").alias("CustomerName"),
        F.col("o_orderpriority").alias("PaymentMethod"),
    )
    products = table("part").select(
        "p_partkey",
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
        text("p_retailprice").alias("ListPrice"),
    )
    stores = table("supplier").join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    stores = stores.select("s_suppkey", F.col("n_name").alias("StoreLocation"))
    # Orders grow with the lines and are never broadcast, so small data takes the same plan.
    lines = (
        table("lineitem")
        .join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(products, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders.hint("shuffle_merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    line = F.col("l_orderkey") + F.col("l_linenumber")
    columns = {
        "ProductID": F.concat(F.lit("P"), text("l_partkey")),
        "StoreID": F.concat(F.lit("S"), text("l_suppkey")),
        "Quantity": F.when(line % 83 == 0, F.lit("0"))
        .when(line % 89 == 0, F.lit("abc"))
        .otherwise(F.col("l_quantity").cast("int").cast("string")),
        "UnitPrice": F.when(line % 79 == 0, F.lit("N/A")).otherwise(F.col("ListPrice")),
        "TotalPrice": text("l_extendedprice"),
    }
    return lines.select(*(columns.get(name, F.col(name)).alias(name) for name in RAW_COLUMNS))
