from __future__ import annotations

import datetime
import random

from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from stratamart.operators import as_of_carry_forward, as_of_join

FIRST = datetime.date(2020, 1, 1)
VERSIONS = "k int, part string, name string, extra int, valid_from date, valid_to date, is_current boolean"
HOW = {"keys": {"fact_k": "k", "fact_part": "part"}, "date_column": "day", "columns": ["name", "valid_from"]}


def day(number):
    return FIRST + datetime.timedelta(days=number)


def some(spark):
    pick = random.Random(4)
    versions = []
    for key in (1, 2, None):
        for part in ("p", "q"):
            starts = sorted(pick.sample(range(100), 8))
            ends = [*starts[1:], None]
            if key == 2:
                ends[3] = starts[3]  # never in force
                ends[5] -= 1  # a day without a version
            versions += [
                (key, part, pick.choice(["x", None, f"n{a}"]), a, day(a), b if b is None else day(b), b is None) for a, b in zip(starts, ends, strict=True)
            ]
    facts = [(at, pick.choice([1, 2, 3, None]), pick.choice(["p", "q", None]), pick.choice([None, day(pick.randrange(110))])) for at in range(600)]
    return spark.createDataFrame(facts, "id int, fact_k int, fact_part string, day date"), spark.createDataFrame(versions, VERSIONS)


def test_it_equals_the_join(spark):
    facts, versions = some(spark)
    found = as_of_carry_forward(facts, versions, **HOW)
    assert found.columns == [*facts.columns, "name", "valid_from"]
    assert rows_of(found) == rows_of(as_of_join(facts, versions, **HOW))
    assert rows_of(as_of_carry_forward(facts, versions.limit(0), **HOW)) == rows_of(as_of_join(facts, versions.limit(0), **HOW))
    assert as_of_carry_forward(facts.limit(0), versions, **HOW).collect() == []


def test_timestamps_count_by_their_day(spark):
    facts, versions = some(spark)
    late = facts.withColumn("day", F.expr("CAST(day AS TIMESTAMP) + INTERVAL 23 HOURS"))
    found = as_of_carry_forward(late, versions, **HOW).drop("day")
    assert rows_of(found) == rows_of(as_of_join(facts, versions, **HOW).drop("day"))


def test_a_hot_key_with_a_thousand_versions(spark):
    """A third of all facts has one key; no step has more rows than there are facts."""
    versions = spark.range(1000).selectExpr(
        "1 AS k", "'p' AS part", "concat('v', id) AS name", "0 AS extra", "date_add(DATE '2020-01-01', CAST(id AS INT)) AS valid_from",
        "IF(id = 999, NULL, date_add(DATE '2020-01-02', CAST(id AS INT))) AS valid_to", "id = 999 AS is_current",
    )
    facts = spark.range(90_000).selectExpr(
        "CAST(id AS INT) AS id", "CAST(IF(id % 3 = 0, 1, id) AS INT) AS fact_k", "'p' AS fact_part", "date_add(DATE '2019-12-31', CAST(id % 1200 AS INT)) AS day"
    )
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    try:
        found = as_of_carry_forward(facts, versions, **HOW)
        hot = found.where("fact_k = 1").groupBy("name").count()
        assert found.count() == 90_000 and hot.count() == 336
        # Every third day, of which one lies before the first version and 66 after the last began.
        assert hot.where("name IS NULL").first()["count"] == 75
        assert hot.where("name = 'v2'").first()["count"] == 75
        assert hot.where("name = 'v999'").first()["count"] == 66 * 75
        plan = plan_of(found)
        # The facts are joined by key and day, so those of the hot key are dealt out.
        assert "slice_day" in plan[plan.index("SortMergeJoin") :].split("\n")[0]
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
