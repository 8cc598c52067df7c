"""What steps leave on disk between each other, measured in the folders of a session of its own."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import glob, sys, time
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from stratamart.llm.shared import stored
folder = sys.argv[1]
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.local.dir", f"{folder}/local").config("spark.checkpoint.dir", f"{folder}/shared").getOrCreate()
)
setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
rows = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).agg(F.max("id").alias("most"))
wanted = sorted((at % 7, at) for at in range(993, 1000))
for before in (None, "false"):
    if before is not None:
        spark.conf.set(setting, before)
    there = set(glob.glob(f"{folder}/local/**/shuffle_*.data", recursive=True))
    back = stored(rows, "rows")
    for _ in range(20):
        left = set(glob.glob(f"{folder}/local/**/shuffle_*.data", recursive=True)) - there
        if not left:
            break
        time.sleep(0.2)
    assert not left, left
    assert spark.conf.get(setting, None) == before
    assert sorted(map(tuple, back.collect())) == wanted
spark.stop()
"""


def test_shuffle_files_go_when_rows_are_stored(folder):
    env = {**os.environ, "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", RUN, folder], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
