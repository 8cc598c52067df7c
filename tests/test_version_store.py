from __future__ import annotations

import datetime
import os

import pytest
from helpers import plan_of, rows_of

from stratamart import storage
from stratamart.operators import scd2_apply, scd2_bootstrap
from stratamart.sinks import VersionStore

D1, D2, D3, D4 = (datetime.date(2024, 1, day) for day in (1, 2, 3, 4))
DAYS = {
    D1: [(1, "a"), (2, "b"), (3, "c")],
    D2: [(1, "A"), (2, "b"), (4, "d")],
    D3: [(1, "AA"), (3, None), (5, "e")],
}


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, a string")


def filled(spark, folder):
    store = VersionStore(spark, folder)
    counts = [store.apply(frame(spark, rows), ["k"], ["a"], day) for day, rows in DAYS.items()]
    return store, counts


def in_memory(spark, until):
    state = None
    for day, rows in DAYS.items():
        if day <= until:
            incoming = frame(spark, rows)
            if state is None:
                state = scd2_bootstrap(incoming, day)
            else:
                state = scd2_apply(state, incoming, ["k"], ["a"], day)
    return rows_of(state)


def test_store_equals_the_pure_operator(spark, folder):
    store, counts = filled(spark, folder)
    assert store.runs() == [D1, D2, D3]
    for day in DAYS:
        assert rows_of(store.read(as_of=day)) == in_memory(spark, day)
    assert rows_of(store.read(as_of=D4)) == rows_of(store.read()) == in_memory(spark, D3)
    current = [row for row in in_memory(spark, D3) if row[4]]
    assert rows_of(store.current()) == current
    assert [(c["Changed"], c["New"], c["Unchanged"]) for c in counts] == [
        (0, 3, 0),
        (1, 1, 2),
        (2, 1, 2),
    ]
    assert counts[2]["Active"] == len(current)


def test_only_open_versions_are_read_and_written(spark, folder):
    store, _ = filled(spark, folder)
    location = plan_of(store.current())
    assert "state=closed" not in location
    closed = os.listdir(f"{folder}/run_date={D2}/state=closed")
    store.apply(frame(spark, DAYS[D3]), ["k"], ["a"], D4)
    assert os.listdir(f"{folder}/run_date={D2}/state=closed") == closed


def test_rerun_leaves_the_same_table(spark, folder):
    store, _ = filled(spark, folder)
    before = rows_of(store.read())
    store.apply(frame(spark, DAYS[D3]), ["k"], ["a"], D3)
    assert rows_of(store.read()) == before
    assert store.runs() == [D1, D2, D3]


def test_rerun_with_corrected_rows_starts_from_the_day_before(spark, folder):
    store, _ = filled(spark, folder)
    store.apply(frame(spark, [(1, "A"), (3, "c")]), ["k"], ["a"], D3)
    assert rows_of(store.read()) == in_memory(spark, D2)


def test_a_day_in_the_past_needs_replay(spark, folder):
    store, _ = filled(spark, folder)
    with pytest.raises(ValueError, match="later than"):
        store.apply(frame(spark, DAYS[D2]), ["k"], ["a"], D2)
    before = rows_of(store.read())
    for day in (D2, D3):
        store.apply(frame(spark, DAYS[day]), ["k"], ["a"], day, replay=True)
    assert rows_of(store.read()) == before


def test_first_day_can_be_repeated_but_not_preceded(spark, folder):
    store = VersionStore(spark, folder)
    store.apply(frame(spark, DAYS[D2]), ["k"], ["a"], D2)
    store.apply(frame(spark, DAYS[D1]), ["k"], ["a"], D2)
    assert store.read().count() == 3
    with pytest.raises(ValueError, match="starts with"):
        store.apply(frame(spark, DAYS[D1]), ["k"], ["a"], D1, replay=True)


def test_a_run_that_died_is_ignored(spark, folder):
    store, _ = filled(spark, folder)
    os.remove(f"{folder}/run_date={D3}/_manifest")
    assert store.runs() == [D1, D2]
    assert rows_of(store.read()) == in_memory(spark, D2)
    store.apply(frame(spark, DAYS[D3]), ["k"], ["a"], D3)
    assert rows_of(store.read()) == in_memory(spark, D3)


def test_reading_looks_into_one_run(spark, folder, monkeypatch):
    store = VersionStore(spark, folder)
    first = datetime.date(2024, 1, 1)
    for number in range(12):
        store.apply(frame(spark, [(1, str(number))]), ["k"], ["a"], first + datetime.timedelta(days=number))
    for number in range(50):
        os.makedirs(f"{folder}/run_date={datetime.date(2023, 1, 1) + datetime.timedelta(days=number)}")
    asked = []
    for name in ("exists", "child_names", "read_text"):
        plain = getattr(storage, name)
        monkeypatch.setattr(
            storage, name, lambda session, path, plain=plain: asked.append(path) or plain(session, path)
        )
    assert store.read().count() == 12
    assert len(asked) == 3


def test_loaded_history_is_kept(spark, folder):
    store = VersionStore(spark, folder)
    table = scd2_apply(
        scd2_bootstrap(frame(spark, DAYS[D1]), D1), frame(spark, DAYS[D2]), ["k"], ["a"], D2
    )
    store.load(table, D2, ["k"])
    assert rows_of(store.read()) == in_memory(spark, D2)
    with pytest.raises(ValueError, match="already has runs"):
        store.load(table, D3, ["k"])
    with pytest.raises(ValueError, match="starts with"):
        store.apply(frame(spark, DAYS[D1]), ["k"], ["a"], D2)
    store.apply(frame(spark, DAYS[D3]), ["k"], ["a"], D3)
    assert rows_of(store.read()) == in_memory(spark, D3)


def test_a_table_without_open_versions_is_not_loaded(spark, folder):
    table = scd2_bootstrap(frame(spark, DAYS[D1]), D1).where("NOT is_current")
    with pytest.raises(ValueError, match="at least one"):
        VersionStore(spark, folder).load(table, D1, ["k"])


def test_forgotten_snapshots(spark, folder):
    store, _ = filled(spark, folder)
    before = rows_of(store.read())
    assert store.forget_snapshots(D3) == [D1, D2]
    assert store.forget_snapshots(D4) == []
    assert rows_of(store.read()) == before
    for day in (D1, D2):
        with pytest.raises(LookupError):
            store.read(as_of=day)
    with pytest.raises(LookupError):
        store.apply(frame(spark, DAYS[D3]), ["k"], ["a"], D3)
    store.apply(frame(spark, DAYS[D3]), ["k"], ["a"], D4)
    assert rows_of(store.read()) == before


def test_nothing_known_yet(spark, folder):
    with pytest.raises(LookupError):
        VersionStore(spark, f"{folder}/none").read()
    store, _ = filled(spark, folder)
    with pytest.raises(LookupError):
        store.read(as_of=D1 - datetime.timedelta(days=1))


def test_an_empty_run_is_no_start(spark, folder):
    store = VersionStore(spark, folder)
    store.apply(frame(spark, []), ["k"], ["a"], D1)
    assert store.runs() == []
    store.apply(frame(spark, DAYS[D2]), ["k"], ["a"], D2)
    store.apply(frame(spark, []), ["k"], ["a"], D3)
    assert store.runs() == [D2, D3]
    assert store.current().count() == 3


def test_null_keys_do_not_enter(spark, folder):
    store = VersionStore(spark, folder)
    for day in (D1, D2):
        store.apply(frame(spark, [(None, "x"), (1, "a")]), ["k"], ["a"], day)
        assert rows_of(store.read()) == [(1, "a", D1, None, True)]


def test_attributes_can_be_added(spark, folder):
    store, _ = filled(spark, folder)
    wider = spark.createDataFrame([(1, "AA", 5), (6, "f", 6)], "k int, a string, b int")
    store.apply(wider, ["k"], ["a", "b"], D4)
    found = rows_of(store.read().where("k IN (1, 6)"))
    assert found == [
        (1, "A", None, D2, D3, False),
        (1, "AA", 5, D4, None, True),
        (1, "AA", None, D3, D4, False),
        (1, "a", None, D1, D2, False),
        (6, "f", 6, D4, None, True),
    ]


def open_files(folder, day):
    found = {}
    for at, _, names in os.walk(f"{folder}/run_date={day}/state=open"):
        found |= {os.path.join(at, name): os.path.getmtime(os.path.join(at, name)) for name in names if name.startswith("part-")}
    return found


def test_only_buckets_with_a_change_are_written(spark, folder):
    store = VersionStore(spark, folder, buckets=64)
    rows = [(key, "a") for key in range(1000)]
    store.apply(frame(spark, rows), ["k"], ["a"], D1)
    files = open_files(folder, D1)
    assert len(files) == 64
    # All keys come in again, of which two have changed and one is new.
    again = [(key, "b" if key in (5, 700) else "a") for key in range(1001)]
    counts = store.apply(frame(spark, again), ["k"], ["a"], D2)
    assert (counts["Changed"], counts["New"], counts["Unchanged"], counts["Active"], counts["Total"]) == (2, 1, 998, 1001, 1003)
    assert open_files(folder, D1) == files and 1 <= len(open_files(folder, D2)) <= 3
    assert rows_of(store.current().select("k", "a")) == sorted(again, key=repr)
    # Few keys come in: what is not read counts as unchanged too.
    counts = store.apply(frame(spark, [(5, "c"), (6, "a")]), ["k"], ["a"], D3)
    assert (counts["Changed"], counts["Unchanged"], counts["Active"]) == (1, 1000, 1001)
    assert len(open_files(folder, D3)) == 1
    # Nothing changes: a run, but no files.
    assert store.apply(frame(spark, [(6, "a")]), ["k"], ["a"], D4)["Unchanged"] == 1001
    assert open_files(folder, D4) == {} and store.runs()[-1] == D4
    assert store.read().count() == 1004


def test_buckets_in_use_are_not_forgotten(spark, folder):
    store = VersionStore(spark, folder, buckets=16)
    store.apply(frame(spark, [(key, "a") for key in range(200)]), ["k"], ["a"], D1)
    store.apply(frame(spark, [(7, "b")]), ["k"], ["a"], D2)
    before = rows_of(store.read())
    assert store.forget_snapshots(D3) == [D1]
    assert rows_of(store.read()) == before and len(open_files(folder, D1)) == 15


def test_keys_and_number_of_buckets_stay(spark, folder):
    store, _ = filled(spark, folder)
    with pytest.raises(ValueError, match="by \\['k'\\]"):
        store.apply(frame(spark, DAYS[D1]), ["a"], ["k"], D4)
    before = rows_of(store.read())
    other = VersionStore(spark, folder, buckets=3)
    other.apply(frame(spark, DAYS[D3]).selectExpr("CAST(k AS BIGINT) AS k", "a"), ["k"], ["a"], D4)
    assert rows_of(other.read()) == before
    with pytest.raises(ValueError, match="possible"):
        VersionStore(spark, folder, buckets=1 << 16)


def test_a_key_that_holds_many_versions(spark, folder):
    """One bucket is rewritten day by day; the others stay with their first run."""
    store = VersionStore(spark, folder, buckets=8)
    store.apply(frame(spark, [(key, "0") for key in range(50)]), ["k"], ["a"], D1)
    for number in range(1, 6):
        store.apply(frame(spark, [(1, str(number))]), ["k"], ["a"], D1 + number * (D2 - D1))
    assert store.read().where("k = 1").count() == 6
    assert store.current().count() == 50
