"""Delimited text feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# A malformed row is recognised by its number of fields. With column pruning on, the parser
# only splits off the fields a query needs and lets such rows through, so that count() and
# collect() disagree; every reader and stream of a feed therefore parses whole rows.
# Headers are compared with the schema, since names are otherwise applied by position.
FEED_OPTIONS = {
    "header": "true",
    "mode": "DROPMALFORMED",
    "columnPruning": "false",
    "enforceSchema": "false",
}


#: Where the parser puts the text of a line that has too few or too many fields.
MALFORMED = "MalformedLine"
SOURCE_FILE = "SourceFile"
AUDIT_OPTIONS = {**FEED_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}


def with_malformed(schema: StructType) -> StructType:
    """The columns of a feed, and that for the text of malformed lines."""
    return StructType([*schema.fields, StructField(MALFORMED, StringType())])


def source_file() -> Column:
    """The file a row was read from, for a column beside those of the file, before anything is shuffled.

    The metadata column has the same text, but takes a third of the time of reading a feed.
    """
    name = F.replace(F.input_file_name(), F.lit(":///"), F.lit(":/"))
    return name.alias(SOURCE_FILE)


def field_count(line: str) -> Column:
    """How many fields a line has; commas inside quotes do not separate."""
    bare = F.regexp_replace(line, r'"(?:[^"\\]|\\.|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def malformed(rows: DataFrame, fields: int) -> DataFrame:
    """``MalformedLine, Fields, Reason, SourceFile`` of the lines that are no rows of the feed."""
    count = field_count(MALFORMED)
    reason = F.when(count < fields, F.lit("too few fields")).when(count > fields, F.lit("too many fields"))
    # The text of a line alone cannot be read from a feed, only with a column beside it; a field is
    # never longer than its line.
    field = F.coalesce(F.col(rows.columns[0]).cast("string"), F.lit(""))
    bad = rows.where(F.col(MALFORMED).isNotNull() & (F.length(field) <= F.length(MALFORMED)))
    return bad.select(MALFORMED, count.alias("Fields"), F.coalesce(reason, F.lit("unreadable")).alias("Reason"), SOURCE_FILE)


def read_feed_audited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    recursive: bool = False,
) -> DataFrame:
    """All lines of a feed: its rows as ``read_feed`` gives them, and malformed ones.

    Every row has its ``SourceFile``; a malformed one has its whole text in ``MalformedLine``, which is
    null for all others, and its columns hold what could be read of it. Blank lines and headers
    are no lines of the feed. Spark refuses a query that needs no column but ``MalformedLine`` (such
    as a count of its nulls); ``malformed`` is made for that.
    """
    columns = schema or header_schema(spark, path, recursive)
    reader = spark.read.schema(with_malformed(columns)).options(**AUDIT_OPTIONS)
    rows = reader.option("recursiveFileLookup", recursive).csv(path)
    return rows.select(*columns.names, MALFORMED, source_file())


def header_schema(
    spark: SparkSession, path: str | list[str], recursive: bool = False
) -> StructType:
    """Column names from the header line, all text. Reads the first line only."""
    reader = spark.read.option("header", True).option("recursiveFileLookup", recursive)
    return reader.csv(path).schema


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Rows of a feed as text; rows with too few or too many fields are dropped.

    Without a schema the header names the columns, in whatever order the file has them.
    ``recursive`` reads the folders below as well, such as those of an archive.
    """
    columns = schema or header_schema(spark, path, recursive)
    reader = spark.read.schema(columns).options(**FEED_OPTIONS)
    return reader.option("recursiveFileLookup", recursive).csv(path)


def read_feed_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of a feed with types guessed from all its values, at the cost of one more pass.

    Nothing is dropped: short rows are filled with nulls, surplus fields are ignored.
    """
    return spark.read.csv(path, header=True, inferSchema=True)
