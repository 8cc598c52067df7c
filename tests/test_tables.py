from __future__ import annotations

import datetime
import os

import pytest
from helpers import plan_of, rows_of
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from stratamart import storage
from stratamart.sinks import (
    SnapshotStore,
    append_months,
    append_run,
    publish,
    read_published,
    replace_months,
    replace_run,
    replace_runs,
    union_evolved,
)
from stratamart.sources import read_evolving, read_run, table_exists

D1, D2, D3 = (datetime.date(2024, 1, day) for day in (1, 2, 3))


def numbers(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "v int")


def test_append_and_replace(spark, folder):
    append_run(numbers(spark, 1), folder, D1)
    append_run(numbers(spark, 2), folder, D1)
    append_run(numbers(spark, 3), folder, D2)
    assert rows_of(read_run(spark, folder, D1)) == [(1, D1), (2, D1)]
    replace_run(numbers(spark, 4), folder, D1)
    assert rows_of(spark.read.parquet(folder)) == [(3, D2), (4, D1)]
    replace_run(numbers(spark), folder, D1)
    assert rows_of(read_run(spark, folder, D1)) == []
    assert rows_of(read_run(spark, folder, D2)) == [(3, D2)]


def test_replacing_a_day_leaves_no_old_partition(spark, folder):
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "v int, s string")
    replace_run(rows, folder, D1, partition_by=["s"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        replace_run(rows.where("s = 'x'"), folder, D1, partition_by=["s"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows_of(read_run(spark, folder, D1).select("v", "s")) == [(1, "x")]


def test_several_run_days_at_once(spark, folder):
    def days(*rows):
        return spark.createDataFrame(list(rows), "v int, run_date date")

    replace_runs(days((1, D1), (2, D2)), folder)
    replace_runs(days((20, D2), (30, D3)), folder)
    assert rows_of(spark.read.parquet(folder)) == [(1, D1), (20, D2), (30, D3)]


def test_other_run_days_are_not_listed(spark, folder):
    append_run(numbers(spark, 1), folder, D1)
    append_run(numbers(spark, 2), folder, D2)
    frame = read_run(spark, folder, D1)
    assert frame.dtypes == [("v", "int"), ("run_date", "date")]
    assert all(f"run_date={D1}" in path for path in frame.inputFiles())
    kept = read_run(spark, folder, D2).where("v > 5")
    assert "GreaterThan(v,5)" in plan_of(kept)


def test_publish_replaces_paths_and_tables(spark, folder):
    for values in ([1, 2], [3]):
        publish(numbers(spark, *values), f"{folder}/plain")
        publish(numbers(spark, *values), f"{folder}/named", table="published_numbers")
    assert rows_of(read_published(spark, f"{folder}/plain")) == [(3,)]
    assert rows_of(spark.table("published_numbers")) == [(3,)]
    assert table_exists(spark, "published_numbers")
    assert table_exists(spark, f"{folder}/plain")
    assert not table_exists(spark, "no_such_numbers")
    assert not table_exists(spark, f"{folder}/none")


def test_a_path_without_marker_is_no_table(spark, folder):
    publish(numbers(spark, 1), f"{folder}/plain")
    os.remove(f"{folder}/plain/version=1/_manifest")
    assert not table_exists(spark, f"{folder}/plain")
    with pytest.raises(LookupError):
        read_published(spark, f"{folder}/plain")


def test_a_dying_publish_leaves_the_old_table(spark, folder):
    publish(numbers(spark, 1), f"{folder}/t", table="dying_numbers")
    broken = numbers(spark, 1, 2).selectExpr("if(v = 2, raise_error('lost'), v) AS v")
    with pytest.raises(Exception, match="lost"):
        publish(broken, f"{folder}/t", table="dying_numbers")
    assert rows_of(read_published(spark, f"{folder}/t")) == [(1,)]
    assert rows_of(spark.table("dying_numbers")) == [(1,)]
    publish(spark.createDataFrame([("x",)], "w string"), f"{folder}/t", table="dying_numbers")
    assert rows_of(spark.table("dying_numbers")) == rows_of(read_published(spark, f"{folder}/t")) == [("x",)]
    assert storage.child_names(spark, f"{folder}/t") == ["version=1", "version=3"]


def test_snapshots(spark, folder):
    store = SnapshotStore(spark, folder)
    for day, values in ((D1, [1]), (D3, [2, 3])):
        store.publish(numbers(spark, *values), day)
    assert rows_of(store.read()) == [(2,), (3,)]
    assert rows_of(store.read(as_of=D2)) == [(1,)]
    with pytest.raises(ValueError, match="later than"):
        store.publish(numbers(spark, 9), D2)
    os.remove(f"{folder}/run_date={D3}/_manifest")
    assert rows_of(store.read()) == [(1,)]


def test_months_are_appended(spark, folder):
    rows = spark.createDataFrame([("2024-01", 1)], "yearmonth string, v int")
    for _ in range(2):
        append_months(rows, folder)
    assert spark.read.parquet(folder).count() == 2


def test_months_are_replaced(spark, folder):
    def months(*rows):
        return spark.createDataFrame(list(rows), "yearmonth string, v int")

    replace_months(months(("2024-01", 1), ("2024-02", 2)), folder)
    for _ in range(2):
        replace_months(months(("2024-02", 20), ("2024-03", 30)), folder)
    stored = spark.read.schema("v int, yearmonth string").parquet(folder)
    assert rows_of(stored) == [(1, "2024-01"), (20, "2024-02"), (30, "2024-03")]


def test_columns_added_over_time(spark, folder):
    wide = spark.createDataFrame([(2, "x")], "v int, w string")
    append_run(numbers(spark, 1), folder, D1)
    append_run(wide, folder, D2)
    assert rows_of(read_evolving(spark, folder)) == [(1, None, D1), (2, "x", D2)]
    schema = StructType([StructField("v", IntegerType()), StructField("w", StringType())])
    assert rows_of(read_evolving(spark, folder, schema).select("v", "w")) == [(1, None), (2, "x")]
    assert rows_of(union_evolved(numbers(spark, 1), wide)) == [(1, None), (2, "x")]


def test_shared_folder_is_below_the_checkpoint_folder(spark):
    first, second = (storage.shared_folder(spark, "name") for _ in range(2))
    assert first != second
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or first.startswith(base.rstrip("/") + "/")


def test_child_names(spark, folder):
    os.makedirs(f"{folder}/b")
    os.makedirs(f"{folder}/a")
    assert storage.child_names(spark, folder) == ["a", "b"]
    assert storage.child_names(spark, f"{folder}/none") == []


def test_exists(spark, folder):
    assert storage.exists(spark, folder)
    assert not storage.exists(spark, f"{folder}/none")
