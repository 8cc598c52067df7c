from __future__ import annotations

import datetime
import random

import pytest
from helpers import plan_of, rows_of

from stratamart.operators import as_of_join

DAY = datetime.date(2024, 1, 1)


def day(number):
    return DAY + datetime.timedelta(days=number)


def inputs(spark):
    pick, versions = random.Random(3), []
    for key in range(20):
        starts = sorted(pick.sample(range(60), pick.randrange(1, 6)))
        for start, end in zip(starts, [*starts[1:], None], strict=True):
            until = None if end is None else day(end)
            versions.append((key, f"{key}/{start}", day(start), until, end is None))
    # A third of the facts has one key; key 99 is unknown, and one key is missing.
    keys = [7] * 200 + [pick.randrange(20) for _ in range(399)] + [99, None]
    facts = [(at, key, day(pick.randrange(-5, 70))) for at, key in enumerate(keys)]
    return (
        facts,
        versions,
        spark.createDataFrame(facts, "id int, k int, d date"),
        spark.createDataFrame(
            versions, "k int, a string, valid_from date, valid_to date, is_current boolean"
        ),
    )


@pytest.mark.parametrize("how", [{}, {"splits": 4}, {"by_month": True}])
def test_brute_force(spark, how):
    facts, versions, fact_frame, version_frame = inputs(spark)
    expected = []
    for number, key, date in facts:
        found = [
            a
            for k, a, start, end, _ in versions
            if k == key and start <= date and (end is None or date < end)
        ]
        assert len(found) <= 1
        expected.append((number, key, date, found[0] if found else None))
    joined = as_of_join(fact_frame, version_frame, {"k": "k"}, "d", ["a"], **how)
    assert joined.columns == ["id", "k", "d", "a"]
    assert rows_of(joined) == sorted(expected, key=repr)


def test_splits_spread_a_key(spark):
    _, _, facts, versions = inputs(spark)
    joined = as_of_join(facts.hint("merge"), versions, {"k": "k"}, "d", ["a"], splits=4)
    assert "fact_split" in plan_of(joined).split("Exchange hashpartitioning(")[1].split(")")[0]


def test_adaptive_execution_splits_a_hot_key(spark):
    low = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    facts = spark.range(0, 60000, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 7, cast(id % 1000 AS int)) AS k", "date'2024-01-05' AS d"
    )
    versions = spark.range(1000).selectExpr(
        "cast(id AS int) AS k", "id AS a", "date'2024-01-01' AS valid_from",
        "cast(null AS date) AS valid_to", "true AS is_current",
    )
    before = {name: spark.conf.get(name) for name in low}
    for name, value in low.items():
        spark.conf.set(name, value)
    try:
        joined = as_of_join(facts, versions.hint("merge"), {"k": "k"}, "d", ["a"])
        assert len(joined.where("a = k").collect()) == 60000
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
