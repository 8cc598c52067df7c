from __future__ import annotations

import datetime
import math
import random

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from stratamart.functions import exact_sum
from stratamart.operators import with_year_month
from stratamart.plans.measures import monthly_kpi, regional_sales_trend

FACT = """OrderID int, OrderDate date, CustomerID string, StoreID string, Quantity int,
    TotalPrice double"""


def fact(spark, *rows):
    return spark.createDataFrame(list(rows), FACT)


def sales(spark):
    pick = random.Random(5)
    rows = []
    for order in range(500):
        date = datetime.date(2024, pick.randrange(1, 13), pick.randrange(1, 28))
        customer = "C0" if order % 3 == 0 else f"C{pick.randrange(30)}"
        price = pick.randrange(100, 99999) / 100
        rows.append((order, date, customer, f"S{order % 4}", pick.randrange(1, 9), price))
    return rows


def test_monthly_kpi_by_hand(spark):
    day = datetime.date(2024, 3, 9)
    rows = [
        (1, day, "C1", "S1", 1, 10.25),
        (1, day, "C1", "S1", 1, 10.25),
        (2, day, "C2", "S1", 1, 100.0),
        (3, datetime.date(2023, 12, 31), None, "S1", 1, None),
    ]
    assert rows_of(monthly_kpi(fact(spark, *rows))) == [
        ("2023-12", None, 1, None, 0),
        ("2024-03", 121.0, 2, 60.0, 2),
    ]


def test_both_ways_of_counting_orders_agree(spark):
    frame = fact(spark, *sales(spark))
    one_row = monthly_kpi(frame, one_row_per_order=True)
    assert rows_of(one_row) == rows_of(monthly_kpi(frame))
    assert "Expand" not in plan_of(one_row)
    assert "Expand" in plan_of(monthly_kpi(frame))


def test_months_come_in_order(spark):
    months = [row.yearmonth for row in monthly_kpi(fact(spark, *sales(spark))).collect()]
    assert months == sorted(months) and len(months) == 12


def test_half_units_round_up_in_any_row_order(spark):
    pick = random.Random(1)
    cents = [pick.randrange(1, 10**7) for _ in range(3000)]
    cents.append(50 - sum(cents) % 100 + 100)
    expected = float((sum(cents) + 50) // 100)
    frame = spark.createDataFrame([(cent / 100,) for cent in cents], "p double")
    for parts in (1, 3, 8):
        total = frame.repartition(parts).agg(F.round(exact_sum("p"))).collect()[0][0]
        assert total == expected


def test_exact_sum(spark):
    def total(*values):
        frame = spark.createDataFrame([(value,) for value in values], "p double")
        return frame.agg(exact_sum("p")).collect()[0][0]

    assert total(0.1, 0.2) == 0.3
    assert total(None, None) is None
    assert total(None, 2.5) == 2.5
    assert total(1 / 3, 1.0) == 1.333333
    assert total(-0.05, -12.34, 2.0) == -10.39
    assert total(0.00001, 1.0) == 1.00001
    assert total(9e14, 9e14, 0.01) == 1.8e15 + 0.01
    for bad in (1e15, -1e300, math.inf, math.nan):
        with pytest.raises(Exception, match="p is not an amount"):
            total(bad, 1.0)


def test_five_decimals_in_any_row_order(spark):
    pick = random.Random(2)
    parts = [pick.randrange(-(10**12), 10**12) for _ in range(4000)]
    frame = spark.createDataFrame([(part / 100_000,) for part in parts], "p double")
    for number in (1, 3, 8):
        assert frame.repartition(number).agg(exact_sum("p")).first()[0] == sum(parts) / 100_000


def test_regional_trend(spark):
    rows = sales(spark) + [(900, datetime.date(2024, 1, 1), "C1", None, 4, 2.0)]
    start, moved = datetime.date(2024, 1, 1), datetime.date(2024, 5, 16)
    stores = [
        ("S0", "North", start, None, True),
        ("S1", "North", start, moved, False),
        ("S1", "East", moved, None, True),
        ("S2", "South", moved, None, True),
        ("S3", None, start, None, True),
    ]
    expected = {}
    for _, date, _, store, quantity, price in rows:
        place = [s[1] for s in stores if s[0] == store and s[2] <= date and (not s[3] or date < s[3])]
        group = (place[0] if place else None, f"{date:%Y-%m}")
        cents, units = expected.get(group, (0, 0))
        expected[group] = (cents + round(price * 100), units + quantity)
    found = regional_sales_trend(
        fact(spark, *rows),
        spark.createDataFrame(
            stores, "StoreID string, StoreLocation string, valid_from date, valid_to date, is_current boolean"
        ),
    )
    assert found.columns == ["StoreLocation", "yearmonth", "TotalRevenue", "UnitsSold"]
    assert {tuple(row)[:2]: tuple(row)[2:] for row in found.collect()} == {
        group: (cents / 100, units) for group, (cents, units) in expected.items()
    }


def test_year_month(spark):
    dates = with_year_month(fact(spark, *sales(spark))).select("OrderDate", "yearmonth")
    assert all(f"{row.OrderDate:%Y-%m}" == row.yearmonth for row in dates.collect())
