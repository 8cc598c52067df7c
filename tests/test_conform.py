from __future__ import annotations

import datetime
import math

import pytest
from helpers import GOOD, raw_rows, rows_of
from pyspark.sql import functions as F

from stratamart.functions import whole_number
from stratamart.operators import conform, quarantine, sales_fact, type_rows
from stratamart.operators.conform import deduplicate
from stratamart.operators.dimensions import one_row_per_key
from stratamart.sources import retail_feed


def typed(spark, column, *values):
    frame = type_rows(raw_rows(spark, *({column: value} for value in values)))
    return [row[0] for row in frame.select(column).collect()]


def test_dates(spark):
    day = datetime.date(2024, 1, 5)
    texts = ["2024-01-05", "05-01-2024", "2024-1-5", " 2024-01-05", "31-02-2024", "not-a-date"]
    assert typed(spark, "OrderDate", *texts) == [day, day, None, None, None, None]


def test_whole_numbers(spark):
    texts = [" 7 ", "3.0", "abc", "", "99999999999", None]
    assert typed(spark, "Quantity", *texts) == [7, None, None, None, None, None]
    assert typed(spark, "OrderID", "X1", "12") == [None, 12]


def test_the_pattern_of_numbers_leaves_the_cast_as_it_is(spark):
    pieces = ["", " ", "\t", "\x7f", "\u00a0", "\u2003", "+", "-", "7", "007", "1.0", "1e3", "x"]
    pieces += ["\u0663", "2147483647", "2147483648", "_", "0x1", "\n"]
    texts = [a + b + c for a in pieces for b in pieces for c in ("", " ", "\n", "x", "\r\n")]
    frame = spark.createDataFrame([(text,) for text in texts], "t string")
    for kind in ("int", "bigint"):
        plain = F.col("t").try_cast(kind)
        assert frame.where(~whole_number("t", kind).eqNullSafe(plain)).count() == 0


def test_more_orders_than_an_int_can_number(spark):
    raw = raw_rows(spark, {"OrderID": "99999999999"}, {"OrderID": "-7"}, {"OrderID": "3000000000"})
    numbered = sales_fact(conform(raw)).select("SalesID", "OrderID")
    assert rows_of(numbered) == [(0, -7), (1, 3000000000), (2, 99999999999)]
    assert quarantine(raw).count() == 0
    assert [row.OrderID for row in conform(raw, id_type="int").collect()] == [-7]
    refused = quarantine(raw, id_type="int").select("OrderID", "RawOrderID", "failed_rule")
    rule = "OrderID is out of range"
    assert rows_of(refused) == [(None, "3000000000", rule), (None, "99999999999", rule)]


def test_decimal_numbers(spark):
    found = typed(spark, "UnitPrice", "1e3", "12d", "N/A", "NaN")
    assert found[:3] == [1000.0, 12.0, None] and math.isnan(found[3])


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({"OrderID": "X"}, "OrderID is unreadable"),
        ({"OrderID": None}, "OrderID is missing"),
        ({"OrderID": " "}, "OrderID is missing"),
        ({"OrderID": "9" * 30}, "OrderID is out of range"),
        ({"UnitPrice": "NaN"}, "UnitPrice is not an amount"),
        ({"TotalPrice": "1e15"}, "TotalPrice is not an amount"),
        ({"OrderDate": "?"}, "OrderDate is missing"),
        ({"CustomerID": None, "Quantity": "0"}, "CustomerID is missing"),
        ({"ProductID": None}, "ProductID is missing"),
        ({"Quantity": "abc"}, "Quantity is missing"),
        ({"Quantity": "0"}, "Quantity is not positive"),
        ({"Quantity": "-1"}, "Quantity is not positive"),
        ({"UnitPrice": "?"}, "UnitPrice is missing"),
        ({"TotalPrice": None}, "TotalPrice is missing"),
    ],
)
def test_rules(spark, change, rule):
    raw = raw_rows(spark, change)
    assert conform(raw).count() == 0
    assert [row.failed_rule for row in quarantine(raw).collect()] == [rule]


def test_good_row(spark):
    raw = raw_rows(spark, {}, {"CustomerName": None, "StoreID": None, "OrderID": "2"})
    assert quarantine(raw).count() == 0
    product, store = ("P1", "Pen", "Office"), ("S1", "Oslo", "Card", "05-01-2024")
    first = conform(raw).where("OrderID = 1").collect()
    assert [tuple(row) for row in first] == [
        (1, datetime.date(2024, 1, 5), "C1", "Ann", *product, 2, 1.5, 3.0, *store)
    ]


def test_duplicates_go_before_invalid_rows(spark):
    raw = raw_rows(spark, {"Quantity": None}, {"Quantity": "2"})
    assert conform(raw).count() == 0
    assert quarantine(raw).count() == 1


def test_every_row_without_a_readable_id_is_rejected_by_itself(spark):
    raw = raw_rows(spark, {"OrderID": "X1"}, {"OrderID": "X1"}, {"OrderID": None}, {}, {"OrderID": "7", "Quantity": "0"})
    found = quarantine(raw).select("OrderID", "RawOrderID", "failed_rule")
    assert rows_of(found) == [
        (7, "7", "Quantity is not positive"),
        (None, "X1", "OrderID is unreadable"),
        (None, "X1", "OrderID is unreadable"),
        (None, None, "OrderID is missing"),
    ]
    assert conform(raw).count() == 1
    assert deduplicate(type_rows(raw)).where("OrderID IS NULL").count() == 1


def test_the_smallest_row_stays_wherever_it_lies(spark):
    changes = [{"PaymentMethod": f"M{number:03d}"} for number in range(200)]
    raw = raw_rows(spark, *changes, {"OrderID": "2", **{"StoreID": None}}, {"OrderID": "2"})
    for parts in (1, 7):
        kept = conform(raw.repartition(parts, "PaymentMethod"))
        found = {row.OrderID: (row.PaymentMethod, row.StoreID) for row in kept.collect()}
        assert found == {1: ("M000", "S1"), 2: (GOOD["PaymentMethod"], None)}


def test_brute_force(spark):
    feed = retail_feed(spark, "/root/testdata/sf0.001")
    rows = [tuple(row) for row in type_rows(feed).collect()]
    smallest = {}
    for row in rows:
        order = tuple((value is not None, value) for value in row)
        if row[0] not in smallest or order < smallest[row[0]]:
            smallest[row[0]] = order
    expected = sorted((tuple(v for _, v in row) for row in smallest.values()), key=repr)
    assert rows_of(deduplicate(type_rows(feed))) == expected


def test_a_hot_order_reaches_the_shuffle_once_per_task(spark):
    rows = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("OrderID"),
        F.col("id").cast("string").alias("text"),
    )
    found = one_row_per_key(rows, ["OrderID"])
    assert found.where("OrderID = 7").collect()[0].text == "0"
    plan = found._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange") :]
    assert "partial_min" in below_shuffle
