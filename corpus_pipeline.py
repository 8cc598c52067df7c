"""The corpus pipeline: documents of good quality, once each, without benchmark text, as ids.

Each stage works on what the one before has kept, written as Parquet and read again. All but
the last return the columns of ``documents``. A stage removes rows by an anti join with those
it rejects, so rows that it cannot name (without doc_id) stay; only the exact stage, which leaves
one row of equal texts, names these by their text. Rows that repeat a doc_id with other text are
judged one by one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.byte_bpe import encode_documents
from stratamart.llm.decontaminate import contamination
from stratamart.llm.exact_dedup import DigestIndex
from stratamart.llm.near_dedup import near_duplicates
from stratamart.llm.quality import quality_scores
from stratamart.llm.shared import stored, table
from stratamart.storage import shared_folder

#: SQL cannot express the trained classifier and the tokenizer.
ORACLE_SQL = None


def without(docs: DataFrame, rejected: DataFrame, unnamed: bool = False) -> DataFrame:
    """The rows of ``docs`` that ``rejected`` does not name by doc_id and text; with ``unnamed`` also
    those without doc_id, by text."""
    named = rejected.select("doc_id", "text_key").distinct()
    doc_id = F.col("docs.doc_id").cast("long")
    same_id = doc_id.eqNullSafe(F.col("named.doc_id")) if unnamed else doc_id == F.col("named.doc_id")
    same = same_id & (F.xxhash64(doc_id, "docs.text") == F.col("named.text_key"))
    return docs.alias("docs").join(named.alias("named"), same, "left_anti")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scores = quality_scores(docs, table(spark, sf_dir, "labels"))
    return without(docs, scores.where("predicted = 0"))


def once_exactly(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, shared_folder(spark, "pipeline_index"))
    # One row of a group is kept; those that repeat its doc_id and text cannot be told from it yet.
    judged = index.add(docs).groupBy("doc_id", "text_key").agg(F.max("kept").alias("kept"))
    unique = without(docs, judged.where("NOT kept"), unnamed=True)
    # Each task reduces them before the shuffle. Columns of any type are put in order as JSON.
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    key, order = F.xxhash64("text").alias("same_text"), F.to_json(F.struct(*others)) if others else F.lit("")
    reduced = unique.groupBy("doc_id", key).agg(F.min_by(F.struct("text", *others), order).alias("row"))
    return reduced.select(*(name if name == "doc_id" else f"row.{name}" for name in docs.columns))


def once_nearly(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, near_duplicates(docs).where("NOT kept"))


def free_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, judged.where("contaminated"))


def as_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", once_exactly),
    ("MinHash near-dedup", once_nearly),
    ("benchmark decontamination", free_of_benchmark),
    ("byte-level BPE", as_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES, 1):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_stage_{at}")
    return docs
