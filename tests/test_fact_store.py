from __future__ import annotations

import datetime

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from stratamart.operators.facts import year_month
from stratamart.plans.measures import monthly_kpi
from stratamart.schemas import FACT_COLUMNS
from stratamart.sinks import FactStore, KpiStore
from stratamart.sinks.order_index import SLOTS, SlotFilter, slot

D1, D2, D3, D4 = (datetime.date(2024, 1, day) for day in (1, 2, 3, 4))
BLOCK = 1 << 16


def sales(spark, rows):
    """Orders of (id, month, customer), and the price if it is not 1."""
    full = [
        (number, datetime.date(2024, month, 5), customer, "P", "S", 1, 1.0, float(*price or [1.0]), "Card")
        for number, month, customer, *price in rows
    ]
    kinds = "bigint date string string string int double double string".split()
    return spark.createDataFrame(full, ", ".join(f"{a} {b}" for a, b in zip(FACT_COLUMNS, kinds, strict=True)))


def places(store, as_of=None):
    return rows_of(store.read_index(as_of))


def of_fact(store, as_of=None):
    return rows_of(store.read(as_of).select("OrderID", "SalesID", year_month("OrderDate")))


def test_the_index_follows_the_fact(spark, folder):
    store = FactStore(spark, folder, buckets=16)
    store.upsert(sales(spark, [(5, 1, "a"), (-3, 2, "b"), (9 * BLOCK, 2, "a"), (2**50, 3, "a")]), D1)
    first = places(store)
    assert first == of_fact(store) and len(first) == 4
    # One order moves, one stays as it is, two are new, one of them in a block that is known.
    store.upsert(sales(spark, [(5, 3, "c"), (2**50, 3, "a"), (6, 1, "a"), (70 * BLOCK, 1, "a")]), D2)
    assert places(store) == of_fact(store) and len(places(store)) == 6
    assert {row[0]: row[1] for row in places(store)}[5] == {row[0]: row[1] for row in first}[5]
    assert places(store, D1) == first
    # Again, as after a failure, and an empty day.
    second = places(store)
    store.upsert(sales(spark, [(5, 3, "c"), (2**50, 3, "a"), (6, 1, "a"), (70 * BLOCK, 1, "a")]), D2)
    store.upsert(sales(spark, []), D3)
    assert places(store) == second == of_fact(store)
    store.upsert(sales(spark, [(1, 1, "a")]), D4, whole=True)
    assert places(store) == of_fact(store) == [(1, 0, "2024-01")]


def test_few_index_files_are_opened_for_a_small_extract(spark, folder, monkeypatch):
    store = FactStore(spark, folder, buckets=64)
    store.upsert(sales(spark, [(number * BLOCK + 1, 1, "a") for number in range(300)]), D1)
    every = store.read_index().inputFiles()
    assert 50 < len(every) <= 64
    extract = sales(spark, [(7 * BLOCK + 1, 2, "a"), (7 * BLOCK + 2, 2, "a"), (900 * BLOCK, 2, "a")])
    found = store.look_up(extract)
    assert len(found.inputFiles()) <= 2 and rows_of(found) == [(7 * BLOCK + 1, 7, "2024-01")]
    opened = []
    load = FactStore._load_index
    monkeypatch.setattr(FactStore, "_load_index", lambda store, buckets: opened.append(len(buckets)) or load(store, buckets))
    store.upsert(extract, D2)
    assert opened and max(opened) <= 2
    assert places(store) == of_fact(store) and len(places(store)) == 302
    # What the run wrote of the index is those buckets only.
    assert len([name for name in store.read_index().inputFiles() if f"run_date={D2}" in name]) <= 2


def test_rows_of_other_slots_are_dropped_while_scanned(spark, folder):
    store = FactStore(spark, folder, buckets=1)
    store.upsert(sales(spark, [(number * BLOCK, 1, "a") for number in range(200)]), D1)
    chosen = SlotFilter.of(sales(spark, [(5 * BLOCK + 9, 1, "a")]))
    assert len(chosen.slots()) == 1 and chosen.buckets(1) == {0}
    left = store.read_index().where(chosen.may_have())
    assert 1 <= left.count() <= 3 and "Exchange" not in plan_of(left)


def test_slots(spark):
    ids = spark.range(0, 5_000_000, 1000).withColumnRenamed("id", "OrderID").unionByName(spark.createDataFrame([(-(2**63),), (2**63 - 1,)], "OrderID bigint"))
    found = SlotFilter.of(ids)
    assert found.slots() == sorted(row[0] for row in ids.select(slot()).distinct().collect())
    assert len(found.bitmap) == SLOTS // 8 and ids.where(~found.may_have()).isEmpty()
    assert SlotFilter.of(ids.limit(0)).slots() == []


def test_a_store_from_before_the_index(spark, folder):
    from stratamart import storage

    store = FactStore(spark, folder, buckets=8)
    store.upsert(sales(spark, [(1, 1, "a"), (2, 1, "b")]), D1)
    manifest = {key: value for key, value in store._manifest(D1).items() if key in ("months", "touched", "next_id")}
    store._finish(D1, manifest)
    storage.remove(spark, f"{folder}/run_date={D1}/index")
    store.upsert(sales(spark, [(2, 4, "b"), (3, 1, "b")]), D2)
    assert places(store) == of_fact(store) == [(1, 0, "2024-01"), (2, 1, "2024-04"), (3, 2, "2024-01")]


def kpi_rows(frame):
    return rows_of(frame.select("yearmonth", "TotalRevenue", "TotalOrders", "AverageOrderValue", "UniqueCustomers"))


def test_measures_follow_orders_that_move_change_and_go(spark, folder):
    fact, measures = FactStore(spark, f"{folder}/fact"), KpiStore(spark, f"{folder}/kpi")
    days = [
        [(1, 1, "a", 1.1), (2, 1, "a", 2.25), (3, 1, "b"), (4, 2, "c", 0.1)],
        [(3, 2, "b"), (5, 3, "a", 1e14), (2, 1, "d", 2.25)],
        [(4, 4, "c", 0.2), (3, 4, "c")],
        [(1, 1, "a", 7.7)],
    ]
    for day, rows in zip((D1, D2, D3, D4), days, strict=True):
        fact.upsert(sales(spark, rows), day)
        measures.apply(fact.read_changes(day), day)
        assert kpi_rows(measures.read()) == kpi_rows(monthly_kpi(fact.read(), one_row_per_order=True))
        per_customer = fact.read().groupBy("CustomerID", year_month("OrderDate")).agg(F.count("*").alias("Orders"))
        assert rows_of(measures.read_customers()) == rows_of(per_customer.select("CustomerID", "Orders", "yearmonth"))
    # February lost its last orders on the third day, and months that none came in for were not read.
    assert "2024-02" not in [row[0] for row in kpi_rows(measures.read())]
    assert measures._manifest(D4)["months"] == {"2024-01": str(D4), "2024-03": str(D2), "2024-04": str(D3)}
    assert kpi_rows(measures.read(as_of=D2)) == kpi_rows(monthly_kpi(fact.read(as_of=D2), one_row_per_order=True))


def test_measures_of_a_repeated_and_of_a_whole_day(spark, folder):
    fact, measures = FactStore(spark, f"{folder}/fact"), KpiStore(spark, f"{folder}/kpi")
    for day, rows in ((D1, [(1, 1, "a"), (2, 2, "b")]), (D2, [(1, 2, "a")]), (D2, [(1, 2, "a")])):
        fact.upsert(sales(spark, rows), day)
        measures.apply(fact.read_changes(day), day)
    assert kpi_rows(measures.read()) == [("2024-02", 2.0, 2, 1.0, 2)]
    fact.upsert(sales(spark, [(9, 5, "z")]), D3, whole=True)
    measures.apply(fact.read_changes(D3), D3, whole=True)
    assert kpi_rows(measures.read()) == [("2024-05", 1.0, 1, 1.0, 1)]
    fact.upsert(sales(spark, []), D4)
    measures.apply(fact.read_changes(D4), D4)
    assert kpi_rows(measures.read()) == [("2024-05", 1.0, 1, 1.0, 1)]


def test_orders_that_were_never_counted_cannot_be_taken_out(spark, folder):
    measures = KpiStore(spark, folder)
    gone = sales(spark, [(1, 1, "a")]).withColumn("Sign", F.lit(-1))
    with pytest.raises(Exception, match="never counted"):
        measures.apply(gone, D1)
    assert measures.runs() == []


def test_a_customer_with_most_orders_is_one_row_a_task(spark, folder):
    measures = KpiStore(spark, folder)
    hot = spark.range(50_000).selectExpr(
        "id AS OrderID", "DATE '2024-01-05' AS OrderDate", "CASE WHEN id % 3 = 0 THEN concat('c', id) ELSE 'hot' END AS CustomerID", "0.5D AS TotalPrice", "1 AS Sign"
    )
    measures.apply(hot, D1)
    assert kpi_rows(measures.read()) == [("2024-01", 25000.0, 50000, 1.0, 16668)]
    assert measures.read_customers().where("CustomerID = 'hot'").first().Orders == 33333
