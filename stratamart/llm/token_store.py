"""Token ids in files with a shared compression dictionary (operator 5).

Documents lie in ascending order of doc_id (those without one first, equal ids by text). Every
document is one zstandard frame of its ids, ended by an end id, as little-endian numbers of two
or four bytes, whichever the vocabulary needs. All frames use one dictionary, trained on the
serialised ids of at most ``SAMPLE_DOCUMENTS`` documents, which is what makes short documents
small. A folder of such files holds

- ``dictionary``: the dictionary, its SHA-256, the width of ids; one row;
- ``blocks``: rows of some megabytes: the frames of consecutive documents, their offset index
  (ids, tokens before each in the shard, numbers of tokens, byte offsets), the smallest and
  largest doc_id, the shard, and the hash of the dictionary that reads them;
- ``shards``: how many tokens come before each shard. A shard is what one task wrote.

All are Parquet written by Spark, so they go to any store that Spark reaches, and a task that
is repeated leaves nothing twice. ``read`` decodes everything, ``fetch`` some documents: blocks
are skipped by their smallest and largest id, and only the frames asked for are decompressed.

Texts are cut by the byte-level pattern and each distinct piece is encoded once by the
tokenizers library; the ids are those of whole texts, as pieces are encoded independently.
Texts with an added token in them go through the library as a whole. Null counts as an empty
text, which has the end id only.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pieces import TextEncoder
from .shared import hashed_sample, prepare_workers, shuffle_partitions
from .texts import sliced

SAMPLE_DOCUMENTS, SAMPLE_BYTES = 2000, 1 << 16
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
BLOCK_BYTES = 1 << 22


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file that every executor has, its pattern, and the id that ends documents."""

    path: str
    pattern: str
    end_id: int


@lru_cache(maxsize=2)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _encode_pieces(pieces: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    found = [encoding.ids for encoding in _library(path).encode_batch_fast(pieces, add_special_tokens=False)]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())), counts


@lru_cache(maxsize=2)
def encoder(vocabulary: Vocabulary):
    """A function from texts to one array of ids for each, the end id included."""
    library = _library(vocabulary.path)
    added = [token.content for token in library.get_added_tokens_decoder().values()]
    texts_to_ids = TextEncoder(vocabulary.pattern, partial(_encode_pieces, path=vocabulary.path))

    def encode(texts: list[str]) -> list[np.ndarray]:
        ids, at = texts_to_ids.encode(texts)
        out = []
        for text, a, b in zip(texts, at[:-1], at[1:], strict=True):
            own = ids[a:b]
            if any(token in text for token in added):
                own = np.array(library.encode(text, add_special_tokens=False).ids, np.int32)
            out.append(np.append(own, np.int32(vocabulary.end_id)))
        return out

    return encode


def _encoded_sample(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, width: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(vocabulary)
    for batch in batches:
        found = [ids.astype(f"<u{width}").tobytes() for ids in encode([text or "" for text in batch.column("text").to_pylist()])]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["ids"])


def train(documents: DataFrame, vocabulary: Vocabulary, width: int) -> bytes:
    """The dictionary; empty where there is too little to train on, which its name then says.

    The sample are the documents of up to ``SAMPLE_BYTES`` with the smallest hashes of their ids.
    """
    short = documents.where(F.octet_length("text") <= SAMPLE_BYTES)

    def encoded(sample: DataFrame) -> DataFrame:
        return sample.select("text").mapInArrow(partial(_encoded_sample, vocabulary=vocabulary, width=width), "ids binary")

    rows = hashed_sample(short, SAMPLE_DOCUMENTS, documents.count(), ["text"], encoded)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(row["ids"]) for row in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_name(raw: bytes) -> str:
    """The hash by which frames name their dictionary, or that they have none."""
    return hashlib.sha256(raw).hexdigest() if raw else "none"


def _dictionary(raw: bytes):
    return {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}


INDEX = np.dtype([("doc_id", "<i8"), ("named", "u1"), ("start", "<i8"), ("tokens", "<i8"), ("offset", "<i8")])
BLOCKS = "shard int, first_id long, last_id long, n_docs long, n_tokens long, dictionary string, width int, doc_index binary, frames binary"
_BLOCK_NAMES = [part.split()[0] for part in BLOCKS.split(", ")]


def _blocks(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, width: int, raw: bytes) -> Iterator[pa.RecordBatch]:
    encode = encoder(vocabulary)
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **_dictionary(raw))
    name = dictionary_name(raw)
    shard = TaskContext.get().partitionId()
    rows, frames, size, start = [], [], 0, 0

    def block():
        index = np.array(rows, INDEX)
        ids = [row[0] for row in rows if row[1]]
        span = [min(ids, default=None), max(ids, default=None)]
        sums = [len(rows), int(index["tokens"].sum())]
        values = [shard, *span, *sums, name, width, index.tobytes(), b"".join(frames)]
        return pa.RecordBatch.from_pylist([dict(zip(_BLOCK_NAMES, values, strict=True))], schema=_ARROW_BLOCKS)

    for batch in batches:
        for first, last, _, _ in sliced(batch.column("text")):
            texts = [text or "" for text in batch.column("text").slice(first, last - first).to_pylist()]
            names = batch.column("doc_id").slice(first, last - first).to_pylist()
            for doc_id, ids in zip(names, encode(texts), strict=True):
                frame = compressor.compress(ids.astype(f"<u{width}").tobytes())
                rows.append((doc_id or 0, doc_id is not None, start, len(ids), size))
                frames.append(frame)
                size += len(frame)
                start += len(ids)
                if size >= BLOCK_BYTES:
                    yield block()
                    rows, frames, size = [], [], 0
    if rows:
        yield block()


_ARROW_BLOCKS = pa.schema(
    [
        ("shard", pa.int32()),
        *((name, pa.int64()) for name in ("first_id", "last_id", "n_docs", "n_tokens")),
        ("dictionary", pa.string()),
        ("width", pa.int32()),
        ("doc_index", pa.binary()),
        ("frames", pa.binary()),
    ]
)


def write(documents: DataFrame, path: str, vocabulary: Vocabulary, shards: int | None = None) -> None:
    """Write all documents to a new folder; ``shards`` tasks do, by default as many as shuffle partitions."""
    spark = documents.sparkSession
    prepare_workers(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    width = 2 if _library(vocabulary.path).get_vocab_size() <= 1 << 16 and vocabulary.end_id < 1 << 16 else 4
    raw = train(rows, vocabulary, width)
    spark.createDataFrame([(dictionary_name(raw), width, bytearray(raw))], "dictionary string, width int, raw binary").write.parquet(
        f"{path}/dictionary"
    )
    ordered = rows.repartitionByRange(shards or shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(partial(_blocks, vocabulary=vocabulary, width=width, raw=raw), BLOCKS).write.parquet(f"{path}/blocks")
    totals = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("tokens_before")).write.parquet(f"{path}/shards")


def _decoded(batches: Iterator[pa.RecordBatch], raw: bytes, wanted: Sequence[int] | None, with_ids: bool) -> Iterator[pa.RecordBatch]:
    decompressor = zstandard.ZstdDecompressor(**_dictionary(raw))
    name = dictionary_name(raw)
    for batch in batches:
        for block in batch.to_pylist():
            if block["dictionary"] != name:
                raise ValueError(f"frames need dictionary {block['dictionary']}, not {name}")
            index = np.frombuffer(block["doc_index"], INDEX)
            ends = np.append(index["offset"][1:], len(block["frames"]))
            picked = range(len(index)) if wanted is None else np.flatnonzero(np.isin(index["doc_id"], wanted) & (index["named"] == 1))
            frames, out = memoryview(block["frames"]), []
            for at in picked:
                ids = np.frombuffer(decompressor.decompress(frames[index["offset"][at] : ends[at]]), f"<u{block['width']}").astype("<u4")
                if len(ids) != index["tokens"][at]:
                    raise ValueError("a frame and its index differ")
                doc_id = int(index["doc_id"][at]) if index["named"][at] else None
                out.append((doc_id, int(index["start"][at]) + block["tokens_before"], len(ids), zlib.crc32(ids.tobytes()), ids))
            columns = [list(values) for values in zip(*out, strict=True)] if out else [[]] * 5
            arrays = [pa.array(values, pa.int64()) for values in columns[:4]]
            if with_ids:
                arrays.append(pa.array([ids.astype(np.int32) for ids in columns[4]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(arrays)])


def _read(spark: SparkSession, path: str, blocks: DataFrame, wanted: Sequence[int] | None, with_ids: bool) -> DataFrame:
    prepare_workers(spark)
    # One row of at most DICTIONARY_BYTES.
    raw = bytes(spark.read.parquet(f"{path}/dictionary").first()["raw"])
    placed = blocks.join(spark.read.parquet(f"{path}/shards"), "shard")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    columns = ["tokens_before", "dictionary", "width", "doc_index", "frames"]
    return placed.select(*columns).mapInArrow(partial(_decoded, raw=raw, wanted=wanted, with_ids=with_ids), schema)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if wanted, ``ids`` of all documents."""
    return _read(spark, path, spark.read.parquet(f"{path}/blocks"), None, with_ids)


def fetch(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The same, ids included, of a few documents."""
    blocks = spark.read.parquet(f"{path}/blocks")
    near = F.lit(False)
    for doc_id in doc_ids:
        near |= (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)
    return _read(spark, path, blocks.where(near), list(doc_ids), True)
