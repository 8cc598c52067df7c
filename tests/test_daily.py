from __future__ import annotations

import datetime
import os

import pytest
from helpers import GOOD, rows_of

from __spark_entry__ import queries
from stratamart.__main__ import main
from stratamart.plans.daily import PLAIN_DIMENSIONS, Warehouse, read_rejects, read_silver, run_daily
from stratamart.schemas import RAW_COLUMNS
from stratamart.sources import retail_feed

SMALL = "/root/testdata/sf0.001"
D1, D2, D3 = (datetime.date(2024, 1, day) for day in (1, 2, 3))
PLAIN = [*PLAIN_DIMENSIONS, "dim_date"]


def drop(folder, name, *changes):
    os.makedirs(f"{folder}/landing", exist_ok=True)
    lines = [",".join(RAW_COLUMNS)]
    lines += [",".join(str({**GOOD, **change}[name]) for name in RAW_COLUMNS) for change in changes]
    with open(f"{folder}/landing/{name}.csv", "w") as file:
        file.write("\n".join([*lines, ""]))


def state(spark, warehouse):
    """All gold tables."""
    found = {"fact": rows_of(warehouse.fact(spark).read())}
    for name in [*PLAIN, "monthly_kpi"]:
        found[name] = rows_of(warehouse.snapshot(spark, name).read())
    for name in ("customer", "product", "store"):
        found[f"{name} versions"] = rows_of(warehouse.versions(spark, name).read())
    return found


def files_below(folder):
    return {
        os.path.join(at, name): os.path.getmtime(os.path.join(at, name))
        for at, _, names in os.walk(folder)
        for name in names
    }


def kpi(spark, warehouse):
    columns = ["yearmonth", "TotalRevenue", "TotalOrders", "UniqueCustomers"]
    return rows_of(warehouse.snapshot(spark, "monthly_kpi").read().select(*columns))


def test_command_line(spark, folder):
    retail_feed(spark, SMALL).write.option("header", True).csv(f"{folder}/landing")
    main(["--run-date", "2024-01-01", f"{folder}/landing", f"{folder}/root"])
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root")
    assert len(kpi(spark, warehouse)) == queries()["kpi_monthly"](spark, SMALL).count()


def test_one_extract(spark, folder):
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root", archive=f"{folder}/archive")
    retail_feed(spark, SMALL).write.option("header", True).csv(warehouse.landing)
    counts = run_daily(spark, warehouse, D1)
    found = state(spark, warehouse)
    for name in [*PLAIN, "fact"]:
        query = "fact_sales" if name == "fact" else name
        assert found[name] == rows_of(queries()[query](spark, SMALL))
    assert found["monthly_kpi"] == rows_of(queries()["kpi_monthly"](spark, SMALL))
    silver = read_silver(spark, warehouse.silver, D1)
    assert rows_of(silver) == rows_of(queries()["silver_clean"](spark, SMALL))
    rejects = read_rejects(spark, warehouse.silver, D1)
    assert counts["silver"] == {"Accepted": silver.count(), "Rejected": rejects.count()}
    wanted = queries()["silver_rejects"](spark, SMALL)
    assert rows_of(rejects.select(wanted.columns)) == rows_of(wanted)
    assert counts["customer"]["New"] == len(found["dim_customer"])

    run_daily(spark, warehouse, D1)
    assert state(spark, warehouse) == found


def test_extracts_accumulate(spark, folder):
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root")
    may, june = {"OrderDate": "2024-05-05"}, {"OrderDate": "2024-06-05"}
    drop(folder, "a", {"OrderID": 1, **may}, {"OrderID": 2, **may, "CustomerID": "C2"}, {"OrderID": 3, **june})
    run_daily(spark, warehouse, D1)
    assert kpi(spark, warehouse) == [("2024-05", 6.0, 2, 2), ("2024-06", 3.0, 1, 1)]
    first = state(spark, warehouse)

    # A new order in May, and one that moves from June to May.
    drop(folder, "b", {"OrderID": 4, **may, "CustomerID": "C3"}, {"OrderID": 3, **may, "CustomerID": "C4"})
    run_daily(spark, warehouse, D2)
    assert kpi(spark, warehouse) == [("2024-05", 12.0, 4, 4)]
    fact = warehouse.fact(spark).read()
    assert rows_of(fact.select("SalesID", "OrderID", "CustomerID")) == [
        (0, 1, "C1"),
        (1, 2, "C2"),
        (2, 3, "C4"),
        (3, 4, "C3"),
    ]
    assert len(rows_of(warehouse.snapshot(spark, "dim_customer").read())) == 4
    second = state(spark, warehouse)
    assert rows_of(warehouse.fact(spark).read(as_of=D1)) == first["fact"]

    # Months without new orders are not written again.
    drop(folder, "c", {"OrderID": 9, "OrderDate": "2024-07-01"})
    run_daily(spark, warehouse, D3)
    written = os.listdir(f"{folder}/root/gold/fact_sales/run_date={D3}/data")
    assert [name for name in written if "=" in name] == ["yearmonth=2024-07"]
    third = state(spark, warehouse)
    assert third["fact"][:4] == second["fact"]

    # A day in the past is refused before anything is touched; replaying it is possible.
    drop(folder, "d", {"OrderID": 10, **june})
    before = files_below(folder)
    with pytest.raises(ValueError, match="later than"):
        run_daily(spark, warehouse, D1)
    assert files_below(folder) == before
    os.remove(f"{folder}/landing/d.csv")
    for day in (D1, D2, D3):
        run_daily(spark, warehouse, day, replay=True)
    assert state(spark, warehouse) == third


def test_whole_extracts_replace(spark, folder):
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root", whole_extracts=True)
    drop(folder, "a", {"OrderID": 1}, {"OrderID": 2, "OrderDate": "2024-03-01", "StoreID": "S2"})
    run_daily(spark, warehouse, D1)
    drop(folder, "b", {"OrderID": 2, "CustomerName": "Anna"})
    run_daily(spark, warehouse, D2)
    assert rows_of(warehouse.fact(spark).read().select("SalesID", "OrderID")) == [(0, 2)]
    assert kpi(spark, warehouse) == [("2024-01", 3.0, 1, 1)]
    assert len(rows_of(warehouse.snapshot(spark, "dim_store").read())) == 1
    assert warehouse.versions(spark, "customer").read().count() == 2


def test_a_run_that_died_leaves_the_tables_and_is_repeated(spark, folder):
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root")
    drop(folder, "a", {"OrderID": 1})
    run_daily(spark, warehouse, D1)
    first = state(spark, warehouse)
    drop(folder, "b", {"OrderID": 2, "StoreLocation": "Rome"})
    run_daily(spark, warehouse, D2)
    second = state(spark, warehouse)
    for name in os.listdir(f"{folder}/root/gold"):
        os.remove(f"{folder}/root/gold/{name}/run_date={D2}/_manifest")
    assert state(spark, warehouse) == first
    run_daily(spark, warehouse, D2)
    assert state(spark, warehouse) == second


def test_a_day_without_files(spark, folder):
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root")
    drop(folder, "a", {"OrderID": 1})
    run_daily(spark, warehouse, D1)
    before = state(spark, warehouse)
    assert run_daily(spark, warehouse, D2) == {}
    assert state(spark, warehouse) == before
