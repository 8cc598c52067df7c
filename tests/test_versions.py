from __future__ import annotations

import datetime
import random

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from stratamart.operators import (
    rejected_keys,
    scd1_upsert,
    scd2_apply,
    scd2_bootstrap,
    scd2_changed,
    scd2_metrics,
    scd2_summary,
    scd2_tagged,
)
from stratamart.operators.dimensions import versioned_input

D1, D2, D3 = (datetime.date(2024, 1, day) for day in (1, 2, 3))
SCHEMA = "k int, a string, b string"
VERSIONS = f"{SCHEMA}, valid_from date, valid_to date, is_current boolean"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def versions(spark, *rows):
    return spark.createDataFrame(list(rows), VERSIONS)


def apply(existing, incoming, day, **options):
    return scd2_apply(existing, incoming, ["k"], ["a", "b"], day, **options)


def expected_after(existing, incoming, day, null_safe=True):
    """The rule row by row, for one key at a time."""
    arrived = {row[0]: row for row in incoming}
    result, known = [], set()
    for key, a, b, start, end, current in existing:
        if not current:
            result.append((key, a, b, start, end, False))
            continue
        known.add(key)
        new = arrived.get(key)
        differs = new is not None and any(
            before != after and (null_safe or None not in (before, after))
            for before, after in zip((a, b), new[1:], strict=True)
        )
        if differs:
            result.append((key, a, b, start, day, False))
            result.append((*new, day, None, True))
        else:
            result.append((key, a, b, start, end, True))
    result += [(*row, day, None, True) for key, row in arrived.items() if key not in known]
    return sorted(result, key=repr)


def random_rows(pick, count):
    values = ["x", "y", "z", None]
    keys = pick.sample(range(40), count)
    return [(key, pick.choice(values), pick.choice(values)) for key in keys]


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("seed", range(4))
def test_random_days(spark, seed, null_safe):
    pick = random.Random(seed)
    state = rows_of(scd2_bootstrap(frame(spark, *random_rows(pick, 25)), D1))
    for day in (D2, D3):
        incoming = random_rows(pick, 20)
        found = rows_of(
            apply(versions(spark, *state), frame(spark, *incoming), day, null_safe=null_safe)
        )
        assert found == expected_after(state, incoming, day, null_safe)
        state = found

    by_key = {}
    for row in sorted(state, key=lambda row: (row[0], row[3], row[4] or datetime.date.max)):
        by_key.setdefault(row[0], []).append(row)
    for history in by_key.values():
        assert [row[5] for row in history] == [False] * (len(history) - 1) + [True]
        assert history[-1][4] is None
        ends = [row[4] for row in history[:-1]]
        assert ends == [row[3] for row in history[1:]]


def test_change_from_null_is_seen_only_null_safe(spark):
    existing = versions(spark, (1, None, "b", D1, None, True))
    incoming = frame(spark, (1, "a", "b"))
    assert apply(existing, incoming, D2).count() == 2
    assert apply(existing, incoming, D2, null_safe=False).count() == 1
    assert scd2_changed(existing, incoming, ["k"], ["a", "b"]).count() == 1
    assert scd2_changed(existing, incoming, ["k"], ["a", "b"], null_safe=False).count() == 0


def test_null_with_a_known_difference_is_a_change_either_way(spark):
    existing = versions(spark, (1, None, "b", D1, None, True))
    incoming = frame(spark, (1, "a", "c"))
    assert apply(existing, incoming, D2, null_safe=False).count() == 2


def test_null_keys_do_not_enter(spark):
    existing = versions(spark, (1, "a", "b", D1, None, True))
    incoming = frame(spark, (None, "z", "z"), (1, "a", "b"))
    for day in (D2, D3):
        existing = versions(spark, *rows_of(apply(existing, incoming, day)))
    assert rows_of(existing) == [(1, "a", "b", D1, None, True)]
    assert rejected_keys(incoming, ["k"]).count() == 1
    assert versioned_input(incoming, ["k"], ["a", "b"]).count() == 1


def test_repeated_keys_are_reduced_to_one_row(spark):
    incoming = frame(spark, (1, "B", "x"), (1, "A", "y"), (1, "A", "x"), (1, "B", "x"))
    reduced = versioned_input(incoming, ["k"], ["a", "b"])
    assert rows_of(reduced) == [(1, "A", "x")]
    assert rows_of(versioned_input(incoming, ["k"], ["a"])) == [(1, "A")]


def test_the_newest_attributes_win(spark):
    rows = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (1, "older", 0), (2, "p", 1), (2, "q", 1), (2, None, 1)],
        "k int, a string, day int",
    )
    assert rows_of(versioned_input(rows, ["k"], ["a"], newest_by="day")) == [(1, "new"), (2, "q")]


def test_dimension_rows_are_reduced_in_a_hash_map_first(spark):
    rows = frame(spark, (1, "a", "b")).withColumn("day", F.lit(D1))
    for newest in (None, "day"):
        plan = plan_of(versioned_input(rows, ["k"], ["a"], newest_by=newest))
        steps = [line for line in plan.splitlines() if "Aggregate(" in line]
        assert "HashAggregate" in steps[-1] and "SortAggregate" in steps[0]


def test_same_day_rerun_changes_nothing(spark):
    existing = versions(spark, (1, "a", "b", D1, None, True), (2, "c", "d", D1, None, True))
    incoming = frame(spark, (1, "A", "b"), (3, "e", "f"))
    once = rows_of(apply(existing, incoming, D2))
    assert rows_of(apply(versions(spark, *once), incoming, D2)) == once


def test_a_closed_key_opens_again(spark):
    closed = (1, "a", "b", D1, D2, False)
    found = apply(versions(spark, closed), frame(spark, (1, "a", "b")), D3)
    assert rows_of(found) == [closed, (1, "a", "b", D3, None, True)]


def test_empty_sides(spark):
    row = (1, "a", "b")
    assert rows_of(apply(versions(spark), frame(spark, row), D2)) == [(*row, D2, None, True)]
    state = (*row, D1, None, True)
    assert rows_of(apply(versions(spark, state), frame(spark), D2)) == [state]


def test_metrics_and_summary(spark):
    existing = versions(
        spark,
        (1, "a", "b", D1, None, True),
        (2, "c", "d", D1, None, True),
        (2, "old", "d", D1, D1, False),
    )
    tagged = scd2_tagged(
        existing, frame(spark, (1, "A", "b"), (3, "e", "f")), ["k"], ["a", "b"], D2
    )
    assert rows_of(scd2_metrics(tagged)) == [(1, 1, 1, 1, 5, 3, 2)]
    assert rows_of(scd2_summary(tagged, "thing")) == [("thing", 5, 3, 2)]


def test_a_run_shuffles_each_side_once(spark):
    existing = spark.range(1000).selectExpr("cast(id AS int) k", "'a' a", "'b' b")
    existing = scd2_bootstrap(existing, D1)
    incoming = spark.range(1000).selectExpr("cast(id AS int) k", "'A' a", "'b' b")
    plan = plan_of(apply(existing, incoming, D2).hint("merge"))
    assert plan.count("Exchange") <= 2


def test_scd1(spark):
    existing = frame(spark, (1, "a", "b"), (2, "c", "d"))
    incoming = frame(spark, (2, None, "D"), (3, "e", "f"))
    merged = scd1_upsert(existing, incoming, ["k"], ["a", "b"])
    assert rows_of(merged) == [(1, "a", "b"), (2, None, "D"), (3, "e", "f")]


def test_composite_keys(spark):
    existing = scd2_bootstrap(frame(spark, (1, "s", "u"), (1, "t", "v")), D1)
    incoming = frame(spark, (1, "s", "U"), (2, "s", "w"))
    found = scd2_apply(existing, incoming, ["k", "a"], ["b"], D2)
    assert rows_of(found.where(F.col("is_current")).select("k", "a", "b")) == [
        (1, "s", "U"),
        (1, "t", "v"),
        (2, "s", "w"),
    ]
    assert found.count() == 4
