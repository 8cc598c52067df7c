from __future__ import annotations

import datetime
import os

import pytest
from helpers import rows_of
from test_daily import D1, D2, D3, drop, kpi, state

from stratamart.plans import daily
from stratamart.plans.daily import Warehouse, run_daily
from stratamart.sinks import BatchLedger
from stratamart.sinks.runs import DAY, RunFolders

FIRST = datetime.date(2024, 1, 1)
# Commits of one day: the fact, its measures, five snapshots, three histories; the ledger's is the last.
COMMITS = 11


class Died(Exception):
    pass


def order(number):
    """One new order a day; a customer's name changes each third day, and months take turns."""
    return {
        "OrderID": number + 1,
        "CustomerID": f"C{number % 3}",
        "CustomerName": f"Name {number}",
        "OrderDate": f"2024-0{1 + number % 4}-05",
        "StoreID": f"S{number % 2}",
    }


def wanted(days):
    """Fact, names and measures after so many days of which none died."""
    fact = [(n, n + 1, datetime.date(2024, 1 + n % 4, 5), f"C{n % 3}") for n in range(days)]
    names = []
    for n in range(days):
        ends = FIRST + (n + 3) * DAY if n + 3 < days else None
        names.append((f"C{n % 3}", f"Name {n}", FIRST + n * DAY, ends, ends is None))
    months = []
    for month in range(min(days, 4)):
        own = [n for n in range(days) if n % 4 == month]
        months.append((f"2024-0{1 + month}", 3.0 * len(own), len(own), len({n % 3 for n in own})))
    return sorted(fact, key=repr), sorted(names, key=repr), months


def found(spark, warehouse):
    fact = warehouse.fact(spark).read().select("SalesID", "OrderID", "OrderDate", "CustomerID")
    return rows_of(fact), rows_of(warehouse.versions(spark, "customer").read()), kpi(spark, warehouse)


def test_a_run_can_die_at_any_step(spark, folder, monkeypatch):
    """Day after day dies one step later, never to be repeated by hand, and the next makes it up."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root")
    finish, commits = RunFolders._finish, []

    def dies_at(step, day):
        def finishing(store, run_date, manifest):
            if run_date == day:
                commits.append(store.path)
                if len(commits) == step:
                    raise Died
            finish(store, run_date, manifest)

        return finishing

    try:
        steps = [("ingest_available", 0), ("write_silver", 0), ("read_silver", 0), *(("", step) for step in range(1, COMMITS + 1))]
        for number, (name, step) in enumerate(steps):
            day = FIRST + number * DAY
            drop(folder, f"{number:02}", order(number))
            with monkeypatch.context() as patched:
                commits.clear()
                if name:
                    plain = getattr(daily, name)

                    def broken(*args, plain=plain, name=name, day=day, **more):
                        if day in args:
                            if name == "ingest_available":
                                plain(*args, **more)
                            raise Died
                        return plain(*args, **more)

                    patched.setattr(daily, name, broken)
                else:
                    patched.setattr(RunFolders, "_finish", dies_at(step, day))
                with pytest.raises(Died):
                    run_daily(spark, warehouse, day)
            if number:
                # The day before is complete by now, and this one is not in the ledger.
                assert warehouse.ledger(spark).runs()[-1] == day - DAY
        assert commits[-1] == f"{warehouse.root}/ledger" and len(commits) == COMMITS
        drop(folder, "last", order(len(steps)))
        counts = run_daily(spark, warehouse, FIRST + len(steps) * DAY)
        assert counts[f"made up {FIRST + (len(steps) - 1) * DAY}"] == {"Accepted": 1, "Rejected": 0}
        assert found(spark, warehouse) == wanted(len(steps) + 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_several_lost_days(spark, folder, monkeypatch):
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root")
    days = [FIRST + number * DAY for number in range(4)]
    drop(folder, "0", order(0))
    run_daily(spark, warehouse, days[0])
    with monkeypatch.context() as patched:
        patched.setattr(daily, "_run_day", lambda *args: (_ for _ in ()).throw(Died()))
        for number in (1, 2):
            drop(folder, str(number), order(number))
            with pytest.raises(Died):
                run_daily(spark, warehouse, days[number])
    # The last day has no files of its own.
    counts = run_daily(spark, warehouse, days[3])
    assert sorted(counts) == [f"made up {days[1]}", f"made up {days[2]}"]
    assert found(spark, warehouse) == wanted(3)
    assert run_daily(spark, warehouse, days[3]) == {}


def test_an_order_that_comes_in_again_after_a_lost_day(spark, folder, monkeypatch):
    """The later day wins, as if the day before it had not died."""
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root")
    drop(folder, "a", {"OrderID": 1, "Quantity": 9})
    with monkeypatch.context() as patched:
        patched.setattr(daily, "write_silver", lambda *args: (_ for _ in ()).throw(Died()))
        with pytest.raises(Died):
            run_daily(spark, warehouse, D1)
    drop(folder, "b", {"OrderID": 1, "Quantity": 4, "CustomerName": "Ben"})
    run_daily(spark, warehouse, D2)
    assert [row.Quantity for row in warehouse.fact(spark).read().collect()] == [4]
    names = warehouse.versions(spark, "customer").read().select("CustomerName", "valid_from", "valid_to")
    assert rows_of(names) == [("Ann", D1, D2), ("Ben", D2, None)]


def test_whole_extracts_make_up_too(spark, folder, monkeypatch):
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root", whole_extracts=True)
    drop(folder, "a", {"OrderID": 1}, {"OrderID": 2})
    with monkeypatch.context() as patched:
        patched.setattr(daily, "accumulate", lambda *args: (_ for _ in ()).throw(Died()))
        with pytest.raises(Died):
            run_daily(spark, warehouse, D1)
    drop(folder, "b", {"OrderID": 2}, {"OrderID": 3})
    run_daily(spark, warehouse, D2)
    assert rows_of(warehouse.fact(spark).read().select("OrderID")) == [(2,), (3,)]
    assert kpi(spark, warehouse) == [("2024-01", 6.0, 2, 1)]
    assert rows_of(warehouse.fact(spark).read(as_of=D1).select("OrderID")) == [(1,), (2,)]


def test_days_after_a_replayed_one_are_repeated_by_the_next_run(spark, folder):
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root")
    for number, day in enumerate((D1, D2)):
        drop(folder, str(number), order(number))
        run_daily(spark, warehouse, day)
    before = state(spark, warehouse)
    run_daily(spark, warehouse, D1, replay=True)
    assert warehouse.ledger(spark).runs() == [D1]
    assert sorted(run_daily(spark, warehouse, D3)) == [f"made up {D2}"]
    assert state(spark, warehouse) == before


def test_bronze_that_later_runs_passed_over_is_refused(spark, folder):
    """Tables of a library without a ledger: nothing is guessed."""
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root")
    for number, day in enumerate((D1, D2)):
        drop(folder, str(number), order(number))
        run_daily(spark, warehouse, day)
    os.remove(f"{folder}/root/ledger/run_date={D1}/_manifest")
    with pytest.raises(ValueError, match=f"bronze of {D1}"):
        run_daily(spark, warehouse, D3)
    run_daily(spark, warehouse, D3, replay=True)
    assert found(spark, warehouse) == wanted(2)


def test_entries(spark, folder):
    ledger = BatchLedger(spark, folder)
    ledger.record(D1, [2, 0])
    ledger.record(D3, [])
    assert ledger.batches(D1) == [0, 2] and ledger.batches(D3) == []
    assert ledger.unfinished([D3, D2, D1, D3 + DAY], before=D3 + DAY) == [D2]
    assert ledger.unfinished([D2, D1], before=D2) == []
    ledger.reopen(D2)
    assert ledger.runs() == [D1]
