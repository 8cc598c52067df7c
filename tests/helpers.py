from __future__ import annotations

from stratamart.schemas import RAW_COLUMNS

# A feed row that passes every rule.
GOOD = {
    "OrderID": "1",
    "OrderDate": "2024-01-05",
    "CustomerID": "C1",
    "CustomerName": "Ann",
    "ProductID": "P1",
    "ProductName": "Pen",
    "Category": "Office",
    "Quantity": "2",
    "UnitPrice": "1.5",
    "TotalPrice": "3.0",
    "StoreID": "S1",
    "StoreLocation": "Oslo",
    "PaymentMethod": "Card",
}


def raw_rows(spark, *changes):
    """A raw frame with one row per set of changes to the good row."""
    rows = [tuple({**GOOD, **change}[name] for name in RAW_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in RAW_COLUMNS))


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
