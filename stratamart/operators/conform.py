"""Raw text rows to typed, de-duplicated and validated rows, in this order.

The order matters: an invalid row can be the one kept for its order, and is then rejected
together with its valid twins. Rows whose order id cannot be read belong to no order; each of
them is rejected by itself, with its id as it came.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import WHOLE_NUMBER, decimal_number, is_amount, order_date, whole_number
from .dimensions import one_row_per_key

ORDER_KEY = "OrderID"
RAW_KEY = "RawOrderID"


def validity_rules() -> dict[str, Column]:
    """What a row of an order has to satisfy, by name, in the order of reporting failures."""
    return {
        "OrderDate is missing": F.col("OrderDate").isNotNull(),
        "CustomerID is missing": F.col("CustomerID").isNotNull(),
        "ProductID is missing": F.col("ProductID").isNotNull(),
        "Quantity is missing": F.col("Quantity").isNotNull(),
        "Quantity is not positive": F.col("Quantity") > 0,
        "UnitPrice is missing": F.col("UnitPrice").isNotNull(),
        "UnitPrice is not an amount": is_amount("UnitPrice"),
        "TotalPrice is missing": F.col("TotalPrice").isNotNull(),
        "TotalPrice is not an amount": is_amount("TotalPrice"),
    }


def type_rows(raw: DataFrame, id_type: str = "bigint", *more: str) -> DataFrame:
    """The 13 columns of the feed with their types, and ``more`` as they are.

    Order ids that do not fit ``id_type`` become null.
    """
    return raw.select(
        whole_number("OrderID", id_type),
        order_date("OrderDate"),
        "CustomerID",
        "CustomerName",
        "ProductID",
        "ProductName",
        "Category",
        whole_number("Quantity"),
        decimal_number("UnitPrice"),
        decimal_number("TotalPrice"),
        "StoreID",
        "StoreLocation",
        "PaymentMethod",
        *more,
    )


def with_date_text(typed: DataFrame) -> DataFrame:
    return typed.withColumn("OrderDateStr", F.date_format("OrderDate", "dd-MM-yyyy"))


def deduplicate(typed: DataFrame) -> DataFrame:
    """One row per order: the smallest by its other columns, nulls first."""
    return one_row_per_key(typed, [ORDER_KEY])


def conform(raw: DataFrame, id_type: str = "bigint") -> DataFrame:
    """The rows that enter the warehouse."""
    # Rows without an order id cannot pass; leaving them out first spares their shuffle.
    identified = type_rows(raw, id_type).where(F.col(ORDER_KEY).isNotNull())
    valid = deduplicate(identified).where(reduce(and_, validity_rules().values()))
    return with_date_text(valid)


def judge(raw: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per order and every row without a readable order id, with the first rule broken.

    ``failed_rule`` is null for rows that break none; ``RawOrderID`` is the text of an id that
    could not be read. Rows without an id do not take part in the shuffle.
    """
    typed = type_rows(raw, id_type)
    broken = [F.when(~holds, F.lit(rule)) for rule, holds in validity_rules().items()]
    orders = deduplicate(typed.where(F.col(ORDER_KEY).isNotNull())).withColumns(
        {"failed_rule": F.coalesce(*broken), RAW_KEY: F.lit(None).cast("string")}
    )
    raw_id = F.col(ORDER_KEY)
    reason = (
        F.when(raw_id.isNull() | (F.trim(raw_id) == ""), F.lit("OrderID is missing"))
        .when(raw_id.rlike(WHOLE_NUMBER), F.lit("OrderID is out of range"))
        .otherwise(F.lit("OrderID is unreadable"))
    )
    unread = raw.where(whole_number(ORDER_KEY, id_type).isNull())
    # The raw columns are kept beside the typed ones until both are known.
    kept = unread.withColumns({"failed_rule": reason, RAW_KEY: raw_id})
    others = type_rows(kept, id_type, "failed_rule", RAW_KEY)
    return with_date_text(orders.unionByName(others))


def quarantine(raw: DataFrame, id_type: str = "bigint") -> DataFrame:
    """What ``conform`` leaves out, with the first rule broken and the order id as text."""
    rejected = judge(raw, id_type).where(F.col("failed_rule").isNotNull())
    return rejected.withColumn(RAW_KEY, F.coalesce(RAW_KEY, F.col(ORDER_KEY).cast("string")))
