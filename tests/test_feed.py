from __future__ import annotations

import os

import pytest
from helpers import rows_of
from pyspark.sql.types import StringType, StructField, StructType

from stratamart.sources import header_schema, read_feed, read_feed_inferred

ABC = StructType([StructField(name, StringType()) for name in "abc"])
LINES = 'a,b,c\n1,2,3\n1,2\n1,2,3,4\n,,\n\n"x,y",2,3\n'


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as file:
        file.write(text)
    return path


def test_malformed_rows_are_dropped(spark, folder):
    path = write(folder, "a.csv", LINES)
    expected = [("1", "2", "3"), ("x,y", "2", "3"), (None, None, None)]
    assert rows_of(read_feed(spark, path)) == expected
    assert rows_of(read_feed(spark, path, ABC)) == expected


def test_malformed_rows_are_dropped_whatever_is_selected(spark, folder):
    feed = read_feed(spark, write(folder, "a.csv", LINES))
    assert feed.count() == 3
    assert feed.select("a").where("a = '1'").count() == 1


def test_header_names_the_columns(spark, folder):
    path = write(folder, "a.csv", "c,a,b\n3,1,2\n")
    assert header_schema(spark, path).names == ["c", "a", "b"]
    assert rows_of(read_feed(spark, path).select("a", "b", "c")) == [("1", "2", "3")]


def test_files_with_another_column_order_are_refused(spark, folder):
    write(folder, "a.csv", "a,b,c\n1,2,3\n")
    write(folder, "b.csv", "b,a,c\n2,1,3\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_feed(spark, folder, ABC).collect()


def test_inferred_scan_keeps_malformed_rows(spark, folder):
    path = write(folder, "a.csv", "a,b,c\n1,2.5,x\n2,3\n3,4,y,z\n")
    feed = read_feed_inferred(spark, path)
    assert feed.dtypes == [("a", "int"), ("b", "double"), ("c", "string")]
    assert rows_of(feed) == [(1, 2.5, "x"), (2, 3.0, None), (3, 4.0, "y")]


def test_empty_files_and_line_ends(spark, folder):
    write(folder, "a.csv", "")
    write(folder, "b.csv", "a,b,c\n")
    write(folder, "c.csv", "a,b,c\r\n1,2,3\r\n")
    assert rows_of(read_feed(spark, folder, ABC)) == [("1", "2", "3")]
