from __future__ import annotations

import random

import pytest
from helpers import plan_of, raw_rows

from stratamart.operators import conform, sales_fact, with_surrogate_key

LIMITS = {"smallint": 2**15, "int": 2**31, "bigint": 2**63}


def keys_of(kind, seed):
    pick, limit = random.Random(seed), LIMITS[kind]
    dense = range(-2000, 3000)
    sparse = (pick.randrange(-limit, limit) for _ in range(500))
    return sorted({-limit, limit - 1, *dense, *sparse})


@pytest.mark.parametrize("kind", LIMITS)
@pytest.mark.parametrize("parts", [1, 5])
def test_ids_follow_the_order(spark, kind, parts):
    keys = keys_of(kind, seed=parts)
    shuffled = random.Random(0).sample(keys, len(keys))
    rows = spark.createDataFrame([(key,) for key in shuffled], f"k {kind}").repartition(parts)
    found = with_surrogate_key(rows, "id", order_by="k", start=10).collect()
    assert {row.k: row.id for row in found} == {key: at + 10 for at, key in enumerate(keys)}


def test_type_and_empty_input(spark):
    empty = spark.createDataFrame([], "k int, other string")
    numbered = with_surrogate_key(empty, "id", order_by="k")
    assert numbered.dtypes == [("k", "int"), ("other", "string"), ("id", "bigint")]
    assert numbered.count() == 0


def test_only_block_sizes_meet_in_one_task(spark):
    rows = spark.range(1000).selectExpr("cast(id AS int) AS k")
    plan = plan_of(with_surrogate_key(rows, "id", order_by="k"))
    single = plan[plan.index("Exchange SinglePartition") :]
    assert "HashAggregate" in single.splitlines()[1]
    assert plan.count("SinglePartition") == 1
    big = plan_of(with_surrogate_key(rows.selectExpr("cast(k AS bigint) AS k"), "id", "k"))
    assert big.count("SinglePartition") == 1


def test_conformed_rows_are_computed_once(spark):
    fact = sales_fact(conform(raw_rows(spark, {}, {"OrderID": "2"})))
    assert fact.count() == 2
    fact.collect()
    plan = plan_of(fact).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
    assert plan.count("partial_min") == 1
