"""Benchmark decontamination by winnowing (operator 8).

Words are runs of ASCII letters and digits and of all other characters, lower-cased in ASCII.
A window is ``WINDOW`` consecutive words of a benchmark item, or the whole of a shorter item.
A document word inside any occurrence of a window is hit.

1. Of every ``WINDOW - GRAM + 1`` consecutive word ``GRAM``-grams the smallest hash (leftmost of
   equals) is a fingerprint. Each window of 13 words spans exactly that many grams, so it holds
   a fingerprint, the same in an item and in a document: no shared window can be missed. For
   items shorter than a window, all runs of their lengths are fingerprints.
2. Fingerprints of documents meet those of the items in a semi join. The items' table is read
   from the shared folder, so Spark knows its size: it broadcasts a small one and shuffles
   both sides otherwise.
3. Documents with hits are read again; the windows round each hit are hashed as a whole and
   joined with the items' windows. What is found there is exact but for equal 64-bit hashes.

Null and empty texts have no words and are not contaminated; items without words have no
windows. Items that repeat an item_id count as one, items without id hit but are not counted.
Rows that repeat a doc_id are judged by their own text each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx
from .shared import prepare_workers, stored, with_text_key

WINDOW, GRAM = 13, 5
SPAN = WINDOW - GRAM + 1
#: 20 hit words in 400 contaminate.
HIT_SHARE = 20
#: A row that carries the number of words of a document through the semi join.
WORD_COUNT = 0
WORD_COUNT_KEYS = 4096


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, word hashes and words before each text, by slices."""
    for first_row, last_row, data, offsets in tx.sliced(column):
        lower = tx.LOWER[data]
        starts, ends, first = tx.words(lower, offsets, tx.PLAIN_WORD)
        yield first_row, last_row, tx.span_hashes(lower, starts, ends), first


def fingerprints(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints of all texts of a slice."""
    grams = tx.run_hashes(hashes, GRAM)
    best = tx.sliding_argmin(grams, SPAN)
    positions = np.unique(best[tx.run_starts(first, WINDOW)])
    return positions, grams[positions]


def _owner(first: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return np.searchsorted(first, positions, "right") - 1


def item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of each item, and the fingerprints that stand for them."""
    for batch in batches:
        for first_row, last_row, hashes, first in _words(batch.column("text")):
            ids = batch.column("item_id").slice(first_row, last_row - first_row)
            counts = np.diff(first)
            starts = tx.run_starts(first, WINDOW)
            windows = tx.run_hashes(hashes, WINDOW)[starts]
            positions, grams = fingerprints(hashes, first)
            short = [i for i in np.flatnonzero((counts > 0) & (counts < WINDOW))]
            whole = np.array([tx.run_hashes(hashes[first[i] : first[i + 1]], int(counts[i]))[0] for i in short], np.uint64)
            sizes = counts[short]
            owners = np.concatenate([_owner(first, starts), _owner(first, positions), short, short]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(owners)),
                    pa.array(np.concatenate([np.full(len(starts) + len(positions), WINDOW), sizes, sizes]), pa.int32()),
                    pa.array(np.concatenate([windows, grams, whole, whole]).view(np.int64)),
                    pa.array(np.repeat([True, False, True, False], [len(starts), len(positions), len(short), len(short)])),
                ],
                names=["item_id", "size", "hash", "is_window"],
            )


def document_fingerprints(batches: Iterator[pa.RecordBatch], short: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first_row, last_row, hashes, first in _words(batch.column("text")):
            positions, grams = fingerprints(hashes, first)
            rows = np.arange(last_row - first_row)
            owners, sizes = [_owner(first, positions), rows], [np.full(len(positions), WINDOW), np.full(len(rows), WORD_COUNT)]
            # The word counts are dealt to many keys, as there is one for every document.
            own_key = batch.column("text_key").slice(first_row, last_row - first_row).to_numpy().view(np.uint64) % np.uint64(WORD_COUNT_KEYS)
            places, found = [positions - first[owners[0]], np.diff(first)], [grams, own_key]
            for size in short:
                at = tx.run_starts(first, size)
                owner = _owner(first, at)
                owners.append(owner)
                sizes.append(np.full(len(at), size))
                places.append(at - first[owner])
                found.append(tx.run_hashes(hashes, size)[at])
            picked = pa.array(np.concatenate(owners))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name).slice(first_row, last_row - first_row).take(picked) for name in ("doc_id", "text_key")),
                    pa.array(np.concatenate(sizes), pa.int32()),
                    pa.array(np.concatenate(found).view(np.int64)),
                    pa.array(np.concatenate(places), pa.int64()),
                ],
                names=["doc_id", "text_key", "size", "hash", "place"],
            )


def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows round each hit of a document."""
    for batch in batches:
        for first_row, last_row, hashes, first in _words(batch.column("text")):
            owners, sizes, places, found = [], [], [], []
            for row in range(first_row, last_row):
                own = hashes[first[row - first_row] : first[row - first_row + 1]]
                hits = batch.column("hits")[row].as_py()
                by_size: dict[int, list[int]] = {}
                for hit in hits:
                    by_size.setdefault(hit["size"], []).append(hit["place"])
                for size, at in by_size.items():
                    starts = np.unique(at)
                    if size == WINDOW:
                        starts = np.unique((starts[:, None] - np.arange(SPAN)).reshape(-1))
                    starts = starts[(starts >= 0) & (starts + size <= len(own))]
                    owners.append(np.full(len(starts), row))
                    sizes.append(np.full(len(starts), size))
                    places.append(starts)
                    found.append(tx.run_hashes(own, size)[starts])
            if owners:
                picked = pa.array(np.concatenate(owners))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(name).take(picked) for name in ("doc_id", "text_key")),
                        pa.array(np.concatenate(sizes), pa.int32()),
                        pa.array(np.concatenate(found).view(np.int64)),
                        pa.array(np.concatenate(places), pa.int64()),
                    ],
                    names=["doc_id", "text_key", "size", "hash", "place"],
                )


def _union_size(spans: str):
    """How many words the sorted spans ``(place, stop)`` cover."""
    start = F.struct(F.lit(0).cast("long").alias("stop"), F.lit(0).cast("long").alias("covered"))

    def step(state, span):
        begin = F.greatest(span["place"], state["stop"])
        return F.struct(
            F.greatest(span["stop"], state["stop"]).alias("stop"),
            (state["covered"] + F.greatest(span["stop"] - begin, F.lit(0).cast("long"))).alias("covered"),
        )

    return F.aggregate(F.array_sort(spans), start, step, lambda state: state["covered"])


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, text_key`` for every row."""
    spark = documents.sparkSession
    prepare_workers(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    made = stored(items.mapInArrow(item_windows, "item_id string, size int, hash long, is_window boolean"), "items")
    windows = stored(
        made.where("is_window").groupBy("size", "hash").agg(F.collect_set("item_id").alias("items")), "item_windows"
    )
    marker = spark.range(WORD_COUNT_KEYS).selectExpr(f"{WORD_COUNT} AS size", "id AS hash")
    grams = stored(made.where("NOT is_window").select("size", "hash").unionByName(marker).distinct(), "item_fingerprints")
    # At most WINDOW - 1 numbers.
    short = sorted(row["size"] for row in grams.where(f"size BETWEEN 1 AND {WINDOW - 1}").select("size").distinct().collect())

    key = ["doc_id", "text_key"]
    rows = with_text_key(documents)
    schema = "doc_id long, text_key long, size int, hash long, place long"
    marked = rows.mapInArrow(partial(document_fingerprints, short=short), schema).join(grams, ["size", "hash"], "left_semi")
    is_hit = F.col("size") != WORD_COUNT
    by_text = stored(
        marked.groupBy(*key).agg(
            F.max(F.when(~is_hit, F.col("place"))).alias("n_words"),
            F.count_if(~is_hit).alias("copies"),
            F.collect_set(F.when(is_hit, F.struct("size", "place"))).alias("hits"),
        ),
        "document_hits",
    )

    hit = by_text.where(F.size("hits") > 0)
    same = [F.col(f"d.{name}").eqNullSafe(F.col(f"h.{name}")) for name in key]
    texts = rows.alias("d").join(hit.select(*key, "hits").alias("h"), same).select("d.doc_id", "d.text_key", "d.text", "h.hits")
    exact = texts.mapInArrow(extended, schema).join(windows, ["size", "hash"])
    found = exact.groupBy(*key).agg(
        F.collect_set(F.struct("place", (F.col("place") + F.col("size")).alias("stop"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    same = [F.col(f"t.{name}").eqNullSafe(F.col(f"f.{name}")) for name in key]
    judged = by_text.alias("t").join(found.alias("f"), same, "left").select(
        "t.doc_id",
        "t.text_key",
        "n_words",
        F.coalesce(_union_size("spans"), F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"),
    )
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "items",
        "text_key",
    )
