from __future__ import annotations

import datetime
import os

import pytest
from helpers import rows_of

from stratamart.sinks import EvolvingTable

D1, D2, D3, D4 = (datetime.date(2024, 1, day) for day in (1, 2, 3, 4))


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def filled(spark, folder):
    table = EvolvingTable(spark, folder)
    table.write(frame(spark, [(1, "a")], "k int, a string"), D1)
    table.write(frame(spark, [(2, 2.5, "b")], "k int, b double, a string"), D2)
    table.write(frame(spark, [(3,)], "k int"), D3)
    return table


def test_columns_are_gained(spark, folder):
    table = filled(spark, folder)
    assert table.read().columns == ["k", "a", "b", "run_date"]
    assert rows_of(table.read()) == [(1, "a", None, D1), (2, "b", 2.5, D2), (3, None, None, D3)]
    assert rows_of(table.read(as_of=D1)) == [(1, "a", D1)]
    assert rows_of(table.columns()) == [(0, "k", "int", D1), (1, "a", "string", D1), (2, "b", "double", D2)]


def test_no_footer_is_opened_to_plan_a_read(spark, folder):
    table = filled(spark, folder)
    for at, _, names in os.walk(f"{folder}/run_date={D2}"):
        for name in names:
            if name.startswith("part-"):
                os.chmod(os.path.join(at, name), 0o600)
                with open(os.path.join(at, name), "r+b") as file:
                    file.truncate(8)
    assert table.read().columns == ["k", "a", "b", "run_date"]
    assert rows_of(table.read().where(f"run_date = DATE '{D1}'")) == [(1, "a", None, D1)]


@pytest.mark.parametrize(
    ("schema", "row", "message"),
    [
        ("k bigint", (1,), "k int, not k bigint"),
        ("k int, a struct<x: int>", (1, (1,)), "a string, not a struct<x:int>"),
        ("K int", (1,), "k int, not K int"),
        ("k int, run_date string", (1, "x"), "run_date as the name"),
    ],
)
def test_what_does_not_fit_is_refused_before_it_is_written(spark, folder, schema, row, message):
    table = filled(spark, folder)
    before = rows_of(table.read())
    with pytest.raises(ValueError, match=message):
        table.write(frame(spark, [row], schema), D4)
    assert rows_of(table.read()) == before and table.runs() == [D1, D2, D3]
    assert not os.path.exists(f"{folder}/run_date={D4}")


def test_a_day_can_be_repeated_with_other_columns(spark, folder):
    table = filled(spark, folder)
    table.write(frame(spark, [(3, 7)], "k int, c int"), D3)
    assert rows_of(table.columns())[-1] == (3, "c", "int", D3)
    with pytest.raises(ValueError, match="later than"):
        table.write(frame(spark, [(1,)], "k int"), D1)
    table.write(frame(spark, [("x",)], "k string"), D1, replay=True)
    assert rows_of(table.read()) == [("x", D1)]


def test_nullability_is_no_type(spark, folder):
    table = EvolvingTable(spark, folder)
    table.write(spark.range(2), D1)
    table.write(frame(spark, [(None,)], "id bigint"), D2)
    assert rows_of(table.read()) == [(0, D1), (1, D1), (None, D2)]
    with pytest.raises(LookupError):
        EvolvingTable(spark, f"{folder}/none").read()
