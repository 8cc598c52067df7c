"""How often a daily run reads silver, counted in Spark's event log."""

from __future__ import annotations

import glob
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import datetime, sys
from pyspark.sql import SparkSession
from stratamart.plans.daily import Warehouse, run_daily
from stratamart.sources import retail_feed
folder = sys.argv[1]
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.dir", f"{folder}/events").config("spark.eventLog.rolling.enabled", "false")
    .config("spark.eventLog.compress", "false").config("spark.sql.maxMetadataStringLength", "4000").getOrCreate()
)
retail_feed(spark, "/root/testdata/sf0.001").write.option("header", True).csv(f"{folder}/landing")
run_daily(spark, Warehouse(f"{folder}/landing", f"{folder}/warehouse"), datetime.date(2024, 1, 1))
spark.stop()
"""


def scans(plan, found):
    if plan["nodeName"].startswith("Scan parquet"):
        found.append(plan["metadata"].get("Location", ""))
    for child in plan["children"]:
        scans(child, found)


def test_how_often_silver_is_read(folder):
    os.makedirs(f"{folder}/events")
    env = {**os.environ, "PYTHONPATH": ROOT}
    subprocess.run([sys.executable, "-c", RUN, folder], check=True, env=env, capture_output=True, timeout=300)
    plans = {}
    for path in glob.glob(f"{folder}/events/*"):
        with open(path) as lines:
            for event in map(json.loads, lines):
                if "sparkPlanInfo" in event:
                    plans[event["executionId"]] = event["sparkPlanInfo"]
    found = []
    for plan in plans.values():
        scans(plan, found)
    # Five times for its rows, and once for the order ids alone.
    assert sum("/warehouse/silver/" in place for place in found) == 6
