"""Exact duplicates by a persistent digest index (operator 10).

Texts are equal when they are the same after deleting ASCII white space; null counts as empty.
Of equal texts the one with the most code points in the original stays, then the smallest
doc_id; a row without doc_id comes after all others. Exactly one row of a group stays, also where
rows repeat a doc_id, with the same or with other white space, or have none: of those that
still tie, the first as read.

The index is a parquet table, bucketed and sorted by the SHA-256 of the normalised text, in a
folder that outlives the session. New rows are first reduced to one per digest in each task, so
a text that a third of all rows share costs one row per task. What the index does not have is
found by a sort-merge anti join, for which the index is not shuffled (a bucket of several loads is
several sorted files, so Spark sorts it again; ``compacted`` makes one file of them), and is
appended. An append is committed by Spark as a whole; repeating one that failed adds nothing
twice, because the digests it had added are then found.
"""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stored, with_text_key

# The characters that do not count.
WHITE_SPACE = " \t\n\u000b\f\r"

# More than there are places within a doc_id; both together have 38 digits.
_PLACES = Decimal(10**19)


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def digests(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, place, n_points, digest`` of every row, written once and read by the steps after.

    ``place`` orders rows by doc_id, those without one last, and is different for every row.
    """
    doc_id = F.coalesce(F.col("doc_id").cast("decimal(19,0)"), F.lit(Decimal(2**63)))
    return stored(
        with_text_key(documents).select(
            "doc_id",
            "text_key",
            (doc_id * F.lit(_PLACES) + F.monotonically_increasing_id()).cast("decimal(38,0)").alias("place"),
            F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"),
            F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
        ),
        "digests",
    )


def winners(rows: DataFrame) -> DataFrame:
    """``digest, keep_id, keep_place, n_points, group_size``: the row that stays of each group.

    Both aggregations use hash maps on plain numbers and reduce rows before they shuffle.
    """
    lengths = rows.groupBy("digest", "n_points").agg(
        F.min("doc_id").alias("first_id"), F.min("place").alias("first_place"), F.count(F.lit(1)).alias("rows")
    )
    return lengths.groupBy("digest").agg(
        F.max_by("first_id", "n_points").alias("keep_id"),
        F.max_by("first_place", "n_points").alias("keep_place"),
        F.max("n_points").alias("n_points"),
        F.sum("rows").alias("group_size"),
    )


class DigestIndex:
    """The digests seen so far, in a folder that all executors reach.

    ``buckets`` is fixed when the folder is first used: about index bytes / 256 MB, at 40 bytes
    a text.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, n_points BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def compacted(self, path: str) -> DigestIndex:
        """The same index in a new folder, each bucket one sorted file."""
        other = DigestIndex(self.spark, path, self.buckets)
        # Read as plain files: Spark would leave the shuffle out for a table that has buckets, and
        # then not read it by bucket. The new table sorts its buckets itself.
        rows = self.spark.read.schema(self.read().schema).parquet(self.path)
        rows.repartition(self.buckets, "digest").write.insertInto(other.table)
        return other

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Of rows with one digest each those that the index does not have."""
        return rows.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, rows: DataFrame) -> None:
        """Add rows of digests that the index does not have."""
        rows.select("digest", "keep_id", "n_points").write.insertInto(self.table)

    def add(self, documents: DataFrame) -> DataFrame:
        """``doc_id, keep_id, group_size, kept, text_sha256, text_key`` for every row.

        ``group_size`` counts the equal rows that came in now. A text that an earlier call
        brought in keeps its first ``keep_id``, so none of its rows is kept now.
        """
        rows = digests(documents)
        groups = stored(winners(rows), "digest_groups")
        # Written first: the append must not change what it reads.
        fresh = stored(self.unseen(groups), "digest_new")
        self.append(fresh)
        self.spark.catalog.refreshTable(self.table)
        known = self.read().select("digest", "keep_id")
        brought = fresh.select("digest", F.lit(True).alias("new"))
        settled = groups.select("digest", "group_size", "keep_place").join(known, "digest").join(brought, "digest", "left")
        kept = F.col("new").isNotNull() & (F.col("place") == F.col("keep_place"))
        return rows.join(settled, "digest").select(
            "doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "text_key"
        )
