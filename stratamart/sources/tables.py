"""Columnar tables, addressed by path or by catalog name."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import storage


def read_run(spark: SparkSession, path: str, run_date: datetime.date) -> DataFrame:
    """One run day of a table that is partitioned by ``run_date``.

    The folder is named instead of filtered for, so that the files of other days are not
    even listed.
    """
    rows = spark.read.option("basePath", path).parquet(f"{path}/run_date={run_date}")
    return rows.withColumn("run_date", F.col("run_date").cast("date"))


def read_evolving(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """A table whose files have gained columns over time; files without one yield nulls.

    A known schema saves the merge, which has to open the footer of every file.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether a path holds a finished or published table or the catalog knows the name.

    Anything else that goes wrong is raised, so that an unreachable table is never taken
    for a missing one and replaced.
    """
    if "/" in name:
        path = name.rstrip("/")
        complete = storage.matches(spark, f"{path}/version=*/_manifest")
        return complete or storage.exists(spark, f"{path}/_SUCCESS")
    return spark.catalog.tableExists(name)
