"""The operators of this subpackage as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..storage import shared_folder
from . import token_store
from .byte_bpe import encode_documents
from .collocations import collocations
from .decontaminate import contamination
from .exact_dedup import DigestIndex
from .licenses import license_matches
from .merkle import audited
from .near_dedup import near_duplicates
from .oracles import ORACLES as ORACLES
from .quality import quality_scores
from .shared import table
from .substring_dedup import remove_repeated_words
from .suffix_dedup import remove_repeated_bytes
from .surrogates import pseudonymised
from .token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), length=4).drop("text_key")


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, shared_folder(spark, "digest_index"))
    return index.add(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op3_quality_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_key")


@query
def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items", "text_key")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"))


@query
def op6_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(table(spark, sf_dir, "documents"))


@query
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_store.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=2)
    path = shared_folder(spark, "token_store")
    token_store.write(table(spark, sf_dir, "documents"), path, vocabulary)
    return token_store.read(spark, path)


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))


@query
def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(table(spark, sf_dir, "documents"), key=b"registered query, not a secret")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
