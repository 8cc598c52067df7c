"""What keeps the cost of a daily run in proportion to its rows."""

from __future__ import annotations

import datetime
import glob

import pytest
from helpers import plan_of, raw_rows, rows_of
from pyspark.sql import functions as F

from stratamart.catalog.fixtures import Extracts, order_number
from stratamart.functions import order_date
from stratamart.functions.parsing import DAY_FIRST, YEAR_FIRST
from stratamart.operators import conform
from stratamart.schemas import RAW_COLUMNS
from stratamart.sinks import FactStore
from stratamart.sources import read_feed, read_feed_audited, retail_feed

DATES = [
    *("2024-01-05", "05-01-2024", "2024-02-30", "30-02-2024", "2023-02-29", "29-02-2024", "0000-01-01", "01-01-0000", "0001-01-01"),
    *("9999-12-31", "31-12-9999", "2024-1-5", "5-1-2024", "12024-01-05", "+12024-01-05", "-2024-01-05", "05-01-12024", "2024-01", "2024"),
    *("2024-01-05 ", " 2024-01-05", "2024-01-05\n", "05-01-2024\n", "2024-01-05T00:00:00", "2024/01/05", "05/01/2024", "not-a-date", ""),
    *("--------", "1582-10-10", "10-10-1582", "٢٠٢٤-01-05", "2024-13-01", "01-13-2024", "00-01-2024", "2024-00-01", None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Kolkata"])
def test_dates_are_those_of_the_patterns(spark, zone):
    rows = spark.createDataFrame([(text,) for text in DATES], "OrderDate string").repartition(1)
    text = F.col("OrderDate")
    by_pattern = F.when(F.substring(text, 3, 1) == "-", F.try_to_date(text, DAY_FIRST)).otherwise(F.try_to_date(text, YEAR_FIRST))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        both = rows.select(text.alias("given"), order_date("OrderDate"), by_pattern.alias("wanted"))
        # As text, since the days of some years are none of Python's.
        found = both.select("given", F.col("OrderDate").cast("string"), F.col("wanted").cast("string")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [row for row in found if row.OrderDate != row.wanted] == []


def test_a_month_is_one_file_whatever_the_number_of_tasks(spark, folder):
    changes = [{"OrderID": str(at), "OrderDate": f"2024-{at // 2 % 6 + 1:02d}-05"} for at in range(120)]
    rows = conform(raw_rows(spark, *changes))
    fact = FactStore(spark, f"{folder}/fact")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    # Small rows would otherwise be one task in any case.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for number, day in enumerate((datetime.date(2024, 7, 1), datetime.date(2024, 7, 2))):
            fact.upsert(rows.where(F.col("OrderID") % 2 == number), day)
            assert len(glob.glob(f"{folder}/fact/run_date={day}/data/yearmonth=*/part-*")) == 6
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(row.OrderID for row in fact.read().collect()) == list(range(120))


def test_extracts_are_the_orders_by_their_number(spark, sf_dir, folder):
    extracts = Extracts(spark, sf_dir, folder, 3)
    feed = retail_feed(spark, sf_dir)
    for number in range(3):
        extracts.land(number, f"{folder}/landing")
        wanted = feed.where(order_number() % 3 <= number)
        found = read_feed(spark, f"{folder}/landing").select(*RAW_COLUMNS)
        assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    extracts.land(7, f"{folder}/other")
    assert rows_of(read_feed(spark, f"{folder}/other")) == []


def test_lines_are_shuffled_by_their_own_keys_alone(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(retail_feed(spark, sf_dir)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    def depth(line):
        return min(at for at in (line.find("+- "), line.find(":- ")) if at >= 0) if "- " in line else 0

    at = next(at for at, line in enumerate(plan) if "FileScan" in line and "l_orderkey" in line)
    above, reached = [], depth(plan[at])
    for line in reversed(plan[:at]):
        if ("+- " in line or ":- " in line) and depth(line) < reached:
            reached = depth(line)
            above.append(line)
    # By order, product and store.
    assert sum("Exchange" in line for line in above) == 3


def test_files_are_named_as_their_metadata_does(spark, folder):
    path = f"{folder}/a b%20ü=#1"
    raw_rows(spark, {"OrderID": "1"}, {"OrderID": "2"}).coalesce(1).write.option("header", True).csv(path)
    found = read_feed_audited(spark, path).select("SourceFile").distinct().collect()
    wanted = spark.read.csv(path, header=True).select("OrderID", F.col("_metadata.file_path").alias("file")).collect()
    assert {row.SourceFile for row in found} == {row.file for row in wanted}
