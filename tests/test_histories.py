from __future__ import annotations

import datetime
import random

from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from stratamart.operators import scd2_apply, scd2_bootstrap, scd2_from_history, scd_mixed_apply
from stratamart.operators.dimensions import versioned_input
from stratamart.sinks import VersionStore

FIRST = datetime.date(2024, 1, 1)
DAY = datetime.timedelta(days=1)


def feed(spark, rows):
    return spark.createDataFrame(rows, "k int, part string, a string, b int, day date")


def day_by_day(spark, rows, keys, attributes):
    """The days of a feed applied one after another."""
    state = None
    for day in sorted({row[-1] for row in rows if row[-1] is not None}):
        one = versioned_input(feed(spark, [row for row in rows if row[-1] == day]).withColumn("d", F.col("day")), keys, attributes)
        greatest = feed(spark, [row for row in rows if row[-1] == day]).groupBy(*keys).agg(F.max(F.struct(*attributes)).alias("x"))
        one = one.select(*keys).join(greatest, keys).select(*keys, "x.*")
        state = scd2_bootstrap(one, day) if state is None else scd2_apply(state, one, keys, attributes, day)
    return rows_of(state)


def some_rows(days, seed=1):
    pick = random.Random(seed)
    rows = []
    for number in range(days):
        for key in (1, 2, 3, None):
            if pick.random() < 0.6:
                values = (pick.choice(["x", "y", None]), pick.choice([1, None]))
                rows += [(key, pick.choice(["p", "q"]), *values, FIRST + number * DAY)] * pick.choice([1, 2])
    return rows + [(1, "p", "z", 0, None), (7, "p", "only", 1, FIRST + 2 * DAY)]


def test_all_days_at_once_equal_the_days_one_by_one(spark):
    rows = some_rows(9)
    for keys, attributes in ((["k"], ["a", "b"]), (["k", "part"], ["a"])):
        found = scd2_from_history(feed(spark, rows), keys, attributes, "day")
        assert rows_of(found) == day_by_day(spark, rows, keys, attributes)
        assert found.columns == [*keys, *attributes, "valid_from", "valid_to", "is_current"]


def test_a_table_is_carried_on(spark):
    rows = some_rows(8, seed=3)
    cut = FIRST + 4 * DAY
    early = [row for row in rows if row[-1] and row[-1] < cut]
    existing = scd2_from_history(feed(spark, early), ["k"], ["a", "b"], "day")
    # The whole feed again: what the table has seen is in the past.
    later = feed(spark, [row for row in rows if row[-1] and row[-1] >= cut])
    found = scd2_from_history(later, ["k"], ["a", "b"], "day", existing)
    assert rows_of(found) == day_by_day(spark, rows, ["k"], ["a", "b"])
    old = feed(spark, [(1, "p", "late", 9, FIRST - DAY)])
    assert rows_of(scd2_from_history(old, ["k"], ["a", "b"], "day", existing)) == rows_of(existing)


def test_a_bulk_load_starts_a_store(spark, folder):
    rows = some_rows(6, seed=5)
    store = VersionStore(spark, folder)
    store.load(scd2_from_history(feed(spark, rows), ["k"], ["a"], "day"), FIRST + 5 * DAY, ["k"])
    store.apply(feed(spark, [(2, "p", "new", 1, FIRST)]).select("k", "a"), ["k"], ["a"], FIRST + 6 * DAY)
    assert rows_of(store.read()) == day_by_day(spark, [*rows, (2, "p", "new", 1, FIRST + 6 * DAY)], ["k"], ["a"])


def test_a_key_with_most_rows_is_reduced_first(spark):
    hot = spark.range(30_000).selectExpr("1 AS k", "CAST(id % 2 AS STRING) AS a", "date_add(DATE '2024-01-01', CAST(id % 5 AS INT)) AS day")
    found = scd2_from_history(hot, ["k"], ["a"], "day")
    plan = plan_of(found)
    assert plan.index("Window") < plan.index("Aggregate") and found.count() == 1
    assert scd2_from_history(hot.limit(0), ["k"], ["a"], "day").collect() == []


EXISTING = "k int, name string, place string, valid_from date, valid_to date, is_current boolean"
D = [FIRST + number * DAY for number in range(6)]


def mixed(spark, existing, incoming, day=D[5]):
    return rows_of(
        scd_mixed_apply(
            spark.createDataFrame(existing, EXISTING), spark.createDataFrame(incoming, "k int, place string, name string"),
            ["k"], ["name"], ["place"], day,
        )
    )


def test_a_correction_reaches_closed_versions(spark):
    existing = [(1, "Ana", "Oslo", D[0], D[1], False), (1, "Ann", "Rome", D[1], None, True)]
    # The place stays: the name is corrected in both versions, and there is no new one.
    assert mixed(spark, existing, [(1, "Rome", "Anna")]) == [
        (1, "Anna", "Oslo", D[0], D[1], False),
        (1, "Anna", "Rome", D[1], None, True),
    ]
    # The place changes: one more version, all with the corrected name.
    assert mixed(spark, existing, [(1, "Bern", "Anna")]) == [
        (1, "Anna", "Bern", D[5], None, True),
        (1, "Anna", "Oslo", D[0], D[1], False),
        (1, "Anna", "Rome", D[1], D[5], False),
    ]
    # A null is a value too, and a null key is none.
    assert mixed(spark, existing, [(1, "Rome", None), (None, "x", "y")]) == [
        (1, None, "Oslo", D[0], D[1], False),
        (1, None, "Rome", D[1], None, True),
    ]


def test_versions_that_become_equal_are_merged(spark):
    existing = [
        (1, "A", "Oslo", D[0], D[1], False),
        (1, "B", "Oslo", D[1], D[2], False),
        (1, "C", "Rome", D[2], D[3], False),
        (1, "D", "Oslo", D[3], D[4], False),
        (1, "E", "Oslo", D[4], None, True),
        (2, "A", "Oslo", D[0], D[1], False),
        (2, "B", "Oslo", D[1], None, True),
        (3, "A", "Oslo", D[0], D[1], False),
        (3, "A", "Oslo", D[2], None, True),
    ]
    found = mixed(spark, existing, [(1, "Oslo", "Z"), (3, "Oslo", "A"), (4, "Bern", "N")])
    assert found == sorted(
        [
            (1, "Z", "Oslo", D[0], D[2], False),
            (1, "Z", "Rome", D[2], D[3], False),
            (1, "Z", "Oslo", D[3], None, True),
            # Not in the feed: as it was. With a gap between: no one version.
            *existing[5:],
            (4, "N", "Bern", D[5], None, True),
        ],
        key=repr,
    )


def test_without_corrections_it_is_plain_history(spark):
    existing = [(1, "A", "Oslo", D[0], D[1], False), (1, "A", "Rome", D[1], None, True), (2, "B", None, D[0], None, True)]
    incoming = [(1, "Bern", "A"), (2, None, "B"), (3, "Kyiv", "C")]
    frame, new = spark.createDataFrame(existing, EXISTING), spark.createDataFrame(incoming, "k int, place string, name string")
    plain = scd2_apply(frame, new.select("k", "name", "place"), ["k"], ["name", "place"], D[5])
    assert mixed(spark, existing, incoming) == rows_of(plain)
    assert mixed(spark, existing, []) == sorted(existing, key=repr)
    assert mixed(spark, [], incoming) == [(k, name, place, D[5], None, True) for k, place, name in incoming]


def test_a_closed_key_is_opened_again(spark):
    existing = [(1, "A", "Oslo", D[0], D[1], False)]
    assert mixed(spark, existing, [(1, "Oslo", "B")]) == [(1, "B", "Oslo", D[0], D[1], False), (1, "B", "Oslo", D[5], None, True)]
    # Without a gap in between it goes on.
    assert mixed(spark, existing, [(1, "Oslo", "B")], D[1]) == [(1, "B", "Oslo", D[0], None, True)]
