from __future__ import annotations

import datetime
import os

from helpers import GOOD, rows_of
from pyspark.sql import functions as F

from stratamart.plans.daily import Warehouse, run_daily
from stratamart.schemas import RAW_COLUMNS, RAW_FEED
from stratamart.sources import malformed, read_feed, read_feed_audited
from stratamart.streaming import ingest_available, read_bronze, read_malformed

DAY = datetime.date(2024, 1, 1)
HEADER = ",".join(RAW_COLUMNS)


def line(**changes):
    return ",".join(str({**GOOD, **changes}[name]) for name in RAW_COLUMNS)


BAD = [
    ("1,2,3", 3, "too few fields"),
    ("alone", 1, "too few fields"),
    (",", 2, "too few fields"),
    (f"{line()},more", 14, "too many fields"),
    (f'{line(CustomerName=chr(34) + "a,b" + chr(34))},"x,""y"",z"', 14, "too many fields"),
    ('"a,b",c', 2, "too few fields"),
]
FINE = [line(OrderID=1), line(OrderID=2, CustomerName='"Ann, Ben"'), "," * 12, line(OrderID=3, CustomerName='"say ""hi"""')]


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as file:
        file.write("\n".join([HEADER, *lines, "", ""]))


def test_good_and_bad_are_all_lines(spark, folder):
    write(f"{folder}/in", "a", [*FINE, *(text for text, _, _ in BAD)])
    write(f"{folder}/in", "b", [line(OrderID=9), "1,2,3"])
    lines = read_feed_audited(spark, f"{folder}/in", RAW_FEED)
    good = lines.where(F.col("MalformedLine").isNull())
    assert rows_of(good.select(RAW_COLUMNS)) == rows_of(read_feed(spark, f"{folder}/in", RAW_FEED))
    assert lines.count() == len(FINE) + len(BAD) + 2
    files = F.element_at(F.split("SourceFile", "/"), -1)
    found = malformed(lines, len(RAW_COLUMNS)).withColumn("SourceFile", files)
    assert rows_of(found) == sorted([*((*bad, "a.csv") for bad in BAD), (*BAD[0], "b.csv")], key=repr)
    # Without a schema the header names the columns.
    assert len(rows_of(read_feed_audited(spark, f"{folder}/in").where("MalformedLine IS NULL"))) == len(FINE) + 1


def test_the_stream_keeps_them(spark, folder):
    paths = (f"{folder}/in", f"{folder}/bronze", f"{folder}/checkpoint")
    write(paths[0], "a", [*FINE, *(text for text, _, _ in BAD[:3])])
    ingest_available(spark, *paths, DAY)
    write(paths[0], "b", [text for text, _, _ in BAD[3:]])
    ingest_available(spark, *paths, DAY + datetime.timedelta(days=1))
    assert read_bronze(spark, paths[1]).count() == len(FINE)
    assert rows_of(read_malformed(spark, paths[1]).drop("SourceFile")) == sorted(BAD, key=repr)
    assert rows_of(read_malformed(spark, paths[1], DAY).drop("SourceFile")) == sorted(BAD[:3], key=repr)


def test_bronze_from_before_has_none(spark, folder):
    old = spark.createDataFrame([tuple(GOOD.values())], RAW_FEED)
    old.write.parquet(f"{folder}/run_date={DAY}/batch_id=0")
    assert read_bronze(spark, folder).count() == 1
    assert read_malformed(spark, folder).collect() == []


def test_a_day_of_malformed_lines_only(spark, folder):
    warehouse = Warehouse(f"{folder}/landing", f"{folder}/root")
    write(warehouse.landing, "a", [line(OrderID=1)])
    run_daily(spark, warehouse, DAY)
    write(warehouse.landing, "b", ["1,2,3"])
    counts = run_daily(spark, warehouse, DAY + datetime.timedelta(days=1))
    assert counts["silver"] == {"Accepted": 0, "Rejected": 0}
    assert warehouse.fact(spark).read().count() == 1
    assert read_malformed(spark, warehouse.bronze).count() == 1
