"""Sessions, shared folders and tables between the steps of an operator."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..storage import shared_folder, shuffles_end_with_job

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_shipped: set[str] = set()
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers import this library, and hand them rows in batches of a few megabytes.

    Whole texts make batches of the usual ten thousand rows large, on both sides of the pipe to
    each worker; a session that asks for smaller ones than ``BATCH_ROWS`` keeps them.
    """
    if int(spark.conf.get(_BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    if _ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="stratamart-code-")
        archive = shutil.make_archive(f"{folder}/stratamart", "zip", _ROOT, "stratamart")
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, lineage cut."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with shuffles_end_with_job(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_text_key(documents: DataFrame) -> DataFrame:
    """``doc_id, text, text_key``: the key tells rows apart that repeat a doc_id with other text."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.withColumn("text_key", F.xxhash64("doc_id", "text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hashed_sample(
    rows: DataFrame,
    size: int,
    total: int,
    tie_breakers: list[str],
    then: Callable[[DataFrame], DataFrame] = lambda sample: sample,
) -> list[Row]:
    """``size`` rows, those with the smallest hashes of their doc_id; all if there are fewer.

    ``total`` is a guess at how many rows there are. Rows that are most likely not among them are
    left out first, so that tasks send on about ``size`` rows between them and not each; if the
    guess was so wrong that too few are left, more are let through. ``then`` is applied before rows
    come to the driver.
    """
    key, low = F.xxhash64("doc_id"), -(2**63)
    share = min(1.0, (1.3 * size + 100) / max(total, 1))
    while True:
        near = rows if share >= 1 else rows.where(key <= low + int(share * 2**64))
        found = then(near.orderBy(key, "doc_id", *tie_breakers).limit(size)).collect()
        if len(found) >= size or share >= 1:
            return found
        share = min(1.0, share * 16)
