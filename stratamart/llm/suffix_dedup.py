"""Removing repeated byte strings by longest-previous-factor arrays (operator 4).

Texts are UTF-8 bytes. Each byte covered by a string of ``WINDOW`` bytes that also starts in a
document with a smaller doc_id is removed; strings are judged on the input, and matches never
cross documents.

Only strings that can be repeated are compared: ``windows`` finds the anchors that documents
share and deals the windows round them to tasks, each distinct run of windows once. A task puts
the suffixes that start at these windows in order, with the length of the prefix that neighbours
have in common, as far as a window reaches. The previous and the next suffix in that order that
belong to a smaller document give the longest earlier match of each suffix; where it is as long
as a window, the window goes.

Null counts as an empty text; texts shorter than a window are left alone. Rows without doc_id
neither lose bytes nor make others lose them. Rows that repeat a doc_id take part each with its own
text: they lose what smaller ids have and make larger ids lose what they have, but not one another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx
from .shared import prepare_workers, with_text_key
from .windows import BYTES, Runs, bucket_count, rows_with_repeats

WINDOW = BYTES.window
#: Offsets of the eight-byte words that cover a window.
_OFFSETS = (*range(0, WINDOW - 7, 8), WINDOW - 8)


def _words_at(tokens: np.ndarray) -> np.ndarray:
    """For each position the eight bytes from there on as a number that sorts as they do."""
    padded = np.concatenate((tokens, np.zeros(8, np.uint8)))
    out = np.zeros(len(tokens), np.uint64)
    for at in range(8):
        out <<= np.uint64(8)
        out |= padded[at : at + len(tokens)]
    return out


def _equal_bytes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many leading bytes two arrays of eight-byte words have in common."""
    differing = left ^ right
    out = np.zeros(len(left), np.int64)
    for byte in range(1, 9):
        out += differing < (np.uint64(1) << np.uint64(64 - 8 * byte) if byte < 8 else np.uint64(1))
    return out


def suffix_order(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``WINDOW`` bytes, equal ones by position.

    Returns the order and, for each place in it, the length of the prefix that the suffix there
    shares with the one before, at most ``WINDOW``. Only suffixes that still equal a neighbour
    are compared further, eight bytes at a time.
    """
    words = _words_at(tokens)
    count = len(starts)
    order = np.argsort(words[starts], kind="stable")
    common = np.zeros(count, np.int64)
    inner = np.arange(1, count)
    first = words[starts[order]]
    common[1:] = _equal_bytes(first[1:], first[:-1])
    for offset, reached in zip(_OFFSETS[1:], [8 * at for at in range(1, len(_OFFSETS))], strict=True):
        reached = min(reached, WINDOW - 2) if offset == _OFFSETS[-1] else reached
        tied = common >= min(offset, reached)
        tied[0] = False
        member = tied.copy()
        member[:-1] |= tied[1:]
        slots = np.flatnonzero(member)
        if not len(slots):
            break
        group = np.cumsum(~tied)[slots]
        suffixes = order[slots]
        key = words[starts[suffixes] + offset]
        inside = np.lexsort((suffixes, key, group))
        order[slots] = suffixes[inside]
        key = key[inside]
        inner = np.flatnonzero(tied[slots])
        common[slots[inner]] = offset + _equal_bytes(key[inner], key[inner - 1])
    return order, np.minimum(common, WINDOW)


def longest_previous(common: np.ndarray, owners: np.ndarray, at_least: int = 1) -> np.ndarray:
    """For suffixes in order the length of the longest match in an earlier owner, 0 below ``at_least``.

    ``common`` is the prefix shared with the suffix before. Previous and next smaller owners
    are found by following pointers: what lies between a suffix and its pointer never has a
    smaller owner, so a pointer may be followed by that of its target.
    """
    longest = np.zeros(len(owners), np.int64)
    places = np.arange(len(owners))
    before = np.concatenate((common, [0]))
    for step, link in ((-1, before[:-1]), (1, before[1:])):
        pointer, shared = places + step, link.copy()
        live = places[shared >= at_least]
        while len(live):
            smaller = owners[pointer[live]] < owners[live]
            settled = live[smaller]
            longest[settled] = np.maximum(longest[settled], shared[settled])
            live = live[~smaller]
            target = pointer[live]
            shared[live] = np.minimum(shared[live], shared[target])
            pointer[live] = pointer[target]
            live = live[shared[live] >= at_least]
    return longest


def repeated_windows(runs: Runs) -> np.ndarray:
    """Which windows of the runs have an earlier match in a smaller document."""
    starts = tx.ranges(runs.before, runs.sizes)
    owners = np.repeat(runs.docs, runs.sizes)
    order, common = suffix_order(runs.tokens, starts)
    out = np.zeros(len(starts), bool)
    out[order] = longest_previous(common, owners[order], WINDOW) == WINDOW
    return out


def remaining(size: int, spans) -> tuple[np.ndarray, int, int]:
    """Which tokens stay, how many go, and in how many maximal runs."""
    change = np.zeros(size + 1, np.int64)
    for span in spans:
        change[span["start"]] += 1
        change[span["stop"]] -= 1
    gone = np.cumsum(change[:-1]) > 0
    begins = np.count_nonzero(gone[1:] & ~gone[:-1]) + int(size > 0 and gone[0])
    return ~gone, int(gone.sum()), int(begins)


def _remove(batches: Iterator[pa.RecordBatch], with_kept: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_key", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            data, offsets = tx.utf8(part.column("text"))
            rows = []
            for row, spans in enumerate(part.column("spans").to_pylist()):
                own = data[offsets[row] : offsets[row + 1]]
                stays, gone, number = remaining(len(own), spans)
                kept = own[stays].tobytes()
                rows.append((gone, number, hashlib.sha256(kept).hexdigest(), kept))
            columns = [list(values) for values in zip(*rows, strict=True)][: 3 + with_kept]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), *map(pa.array, columns)], names=names)


def remove_repeated_bytes(documents: DataFrame, buckets: int | None = None, with_kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row, and ``kept`` if wanted.

    ``buckets`` is the number of tasks that compare windows, by default ``bucket_count``; a task
    holds about the shared text divided by it, and compares it in parts of a fixed size.
    """
    spark = documents.sparkSession
    prepare_workers(spark)
    buckets = buckets or bucket_count(documents)
    rows = with_text_key(documents)
    touched = rows_with_repeats(rows, BYTES, 1, buckets, repeated_windows, "byte")
    schema = "doc_id long, text_key long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    cleaned = touched.mapInArrow(partial(_remove, with_kept=with_kept), schema).dropDuplicates(["doc_id", "text_key"])
    text = F.coalesce("text", F.lit(""))
    whole = [F.sha2(text, 256).alias("whole_sha256")] + [text.cast("binary").alias("whole")] * with_kept
    base = rows.select("doc_id", "text_key", F.octet_length(text).cast("long").alias("n_bytes"), *whole)
    joined = base.alias("b").join(cleaned.hint("merge").alias("c"), ["doc_id", "text_key"], "left")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        *([F.coalesce("kept", "whole").alias("kept")] if with_kept else []),
    )
