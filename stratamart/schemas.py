"""Column contracts of the layers."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# The columns of the raw feed, all text.
RAW_COLUMNS = [
    "OrderID",
    "OrderDate",
    "CustomerID",
    "CustomerName",
    "ProductID",
    "ProductName",
    "Category",
    "Quantity",
    "UnitPrice",
    "TotalPrice",
    "StoreID",
    "StoreLocation",
    "PaymentMethod",
]

RAW_FEED = StructType([StructField(name, StringType()) for name in RAW_COLUMNS])

# The columns of the sales fact, after its surrogate key.
FACT_COLUMNS = [
    "OrderID",
    "OrderDate",
    "CustomerID",
    "ProductID",
    "StoreID",
    "Quantity",
    "UnitPrice",
    "TotalPrice",
    "PaymentMethod",
]

# The audit columns of a versioned dimension.
VERSION_COLUMNS = ["valid_from", "valid_to", "is_current"]

# The dimensions whose history is kept, with key and tracked attributes.
VERSIONED_DIMENSIONS = {
    "customer": (["CustomerID"], ["CustomerName"]),
    "product": (["ProductID"], ["ProductName", "Category"]),
    "store": (["StoreID"], ["StoreLocation"]),
}
