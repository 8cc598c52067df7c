"""Files that arrive over time, each taken over exactly once."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from .. import storage
from ..schemas import RAW_FEED
from ..sinks.tables import replace_folder
from ..sources.feed import AUDIT_OPTIONS, MALFORMED, SOURCE_FILE, malformed, source_file, with_malformed


def ingest_available(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    run_date: datetime.date,
    archive: str | None = None,
    schema: StructType = RAW_FEED,
    files_per_batch: int = 1000,
) -> None:
    """Copy the feed files that are new in ``landing`` to ``bronze``, then stop.

    The checkpoint remembers the files that were taken. A batch that dies is repeated under
    its old number, and as its folder is overwritten its rows never count twice; ``bronze``
    and ``checkpoint`` belong together and are only ever removed together.

    Malformed lines are kept beside the rows, with their text and file (``read_malformed``).

    With ``archive``, files of finished batches are moved there by a later run that finds
    new files. The archive has to lie outside ``landing``.
    """
    reader = (
        spark.readStream.schema(with_malformed(schema))
        .options(**AUDIT_OPTIONS)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    def store(batch: DataFrame, batch_id: int) -> None:
        # A batch that died on another day has left its folder there.
        for other in storage.matching(spark, f"{bronze}/run_date=*/batch_id={batch_id}"):
            if f"run_date={run_date}/" not in other:
                storage.remove(spark, other)
        replace_folder(batch, f"{bronze}/run_date={run_date}/batch_id={batch_id}")

    query = (
        reader.csv(landing)
        .select(*schema.names, MALFORMED, source_file())
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def has_bronze(spark: SparkSession, bronze: str, run_date: datetime.date) -> bool:
    """Whether any row was taken over on a run day."""
    return storage.matches(spark, f"{bronze}/run_date={run_date}/batch_id=*/part-*")


def bronze_days(spark: SparkSession, bronze: str) -> list[datetime.date]:
    """The run days that have taken files over."""
    fields = (name.partition("=") for name in storage.child_names(spark, bronze))
    return [datetime.date.fromisoformat(day) for key, _, day in fields if key == "run_date"]


def bronze_batches(spark: SparkSession, bronze: str, run_date: datetime.date) -> list[int]:
    """The numbers of the batches of a run day."""
    fields = (name.partition("=") for name in storage.child_names(spark, f"{bronze}/run_date={run_date}"))
    return [int(number) for key, _, number in fields if key == "batch_id"]


def read_bronze(
    spark: SparkSession,
    bronze: str,
    run_date: datetime.date | None = None,
    schema: StructType = RAW_FEED,
) -> DataFrame:
    """The rows taken over so far, or only those of one run day, listing only its files."""
    return _lines(spark, bronze, run_date, schema).where(F.col(MALFORMED).isNull()).select(*schema.names)


def read_malformed(
    spark: SparkSession,
    bronze: str,
    run_date: datetime.date | None = None,
    schema: StructType = RAW_FEED,
) -> DataFrame:
    """``MalformedLine, Fields, Reason, SourceFile`` of the lines that were no rows."""
    return malformed(_lines(spark, bronze, run_date, schema), len(schema))


def _lines(spark: SparkSession, bronze: str, run_date: datetime.date | None, schema: StructType) -> DataFrame:
    """What was taken over; rows from before malformed lines were kept have null for them."""
    more = [StructField(name, StringType()) for name in (MALFORMED, SOURCE_FILE)]
    folders = [StructField("run_date", DateType()), StructField("batch_id", IntegerType())]
    reader = spark.read.schema(StructType([*schema.fields, *more, *folders]))
    path = bronze if run_date is None else f"{bronze}/run_date={run_date}"
    return reader.option("basePath", bronze).parquet(path)
