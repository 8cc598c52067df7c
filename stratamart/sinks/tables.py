"""Tables written whole, by run day or by month."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from .. import storage

# Half to two thirds of the bytes that the default takes.
COMPRESSION = "zstd"


def append_run(df: DataFrame, path: str, run_date: datetime.date) -> None:
    """Add rows to a run day."""
    write_parquet(df, df.write.mode("append"), f"{path}/run_date={run_date}")


def write_parquet(df: DataFrame, writer: DataFrameWriter, path: str) -> None:
    """Write the rows as a writer of theirs says; what was shuffled for them goes with the job."""
    with storage.shuffles_end_with_job(df.sparkSession):
        writer.option("compression", COMPRESSION).parquet(path)


def replace_run(
    df: DataFrame, path: str, run_date: datetime.date, partition_by: Sequence[str] = ()
) -> None:
    """Make a run day hold exactly these rows, also if there are none; other days stay."""
    replace_folder(df, f"{path}/run_date={run_date}", partition_by)


def replace_folder(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Make a folder hold exactly these rows.

    The mode is named since a session may default to the dynamic one, which would leave the
    partitions in place that the new rows do not have.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    write_parquet(df, writer.partitionBy(*partition_by), path)


def replace_runs(df: DataFrame, path: str) -> None:
    """Replace the run days that occur in the ``run_date`` column, all in one job.

    Each task writes a file per day it has rows of; many days at once are better handed over
    clustered, as by ``df.hint("rebalance", "run_date")``.
    """
    _replace_partitions(df, path, "run_date")


def publish(
    df: DataFrame, path: str, table: str | None = None, file_format: str = "parquet"
) -> None:
    """Create or replace a table at a path, and in the catalog if a name is given.

    The rows go to a new folder ``version=N`` below the path, which counts once it is complete;
    until then readers see the version before, which is kept for those that have begun.
    ``file_format`` can be any installed source, ``delta`` for one.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    numbers = _versions(spark, path)
    current = published_version(spark, path)
    folder = f"{path}/version={max(numbers, default=0) + 1}"
    with storage.shuffles_end_with_job(spark):
        df.write.format(file_format).save(folder)
    storage.write_text(spark, f"{folder}/_manifest", file_format)
    if table is not None:
        _point(spark, table, folder, file_format)
    for number in numbers:
        if number != current:
            storage.remove(spark, f"{path}/version={number}")


def published_version(spark: SparkSession, path: str) -> int | None:
    """The number of the last complete version of a published table."""
    for number in reversed(_versions(spark, path)):
        if storage.exists(spark, f"{path.rstrip('/')}/version={number}/_manifest"):
            return number
    return None


def read_published(spark: SparkSession, path: str) -> DataFrame:
    number = published_version(spark, path)
    if number is None:
        raise LookupError(f"{path} has no complete version")
    folder = f"{path.rstrip('/')}/version={number}"
    return spark.read.format(storage.read_text(spark, f"{folder}/_manifest")).load(folder)


def _versions(spark: SparkSession, path: str) -> list[int]:
    fields = (name.partition("=") for name in storage.child_names(spark, path))
    return sorted(int(number) for key, _, number in fields if key == "version")


def _point(spark: SparkSession, table: str, folder: str, file_format: str) -> None:
    """Let a name of the catalog stand for a folder, without touching any other folder."""
    columns = spark.read.format(file_format).load(folder).schema
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == columns:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=folder, source=file_format)


def replace_months(df: DataFrame, path: str) -> None:
    """Replace the months that occur in the rows and keep all others.

    Running it twice leaves the same table. A month is a handful of rows, hence one file.
    """
    _replace_partitions(df.repartition("yearmonth"), path, "yearmonth")


def append_months(df: DataFrame, path: str) -> None:
    """Add the months that occur in the rows, whether or not they are there already."""
    dealt = df.repartition("yearmonth")
    write_parquet(dealt, dealt.write.mode("append").partitionBy("yearmonth"), path)


def union_evolved(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Both frames under the columns of either; a column that one lacks is null there."""
    return older.unionByName(newer, allowMissingColumns=True)


def _replace_partitions(df: DataFrame, path: str, column: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write_parquet(df, writer.partitionBy(column), path)
