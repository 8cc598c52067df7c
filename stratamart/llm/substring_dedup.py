"""Removing repeated word sequences by prefix-partitioned suffix trees (operator 6).

Words are runs of characters other than ASCII white space, unchanged. Each word covered by a
window of ``WINDOW`` consecutive words whose sequence also starts in a document with a smaller
doc_id is removed; windows are judged on the input and never cross documents.

``windows`` finds the word ``WORDS.gram``-grams that stand for windows and that documents share,
and deals the suffixes round them by these grams, which are the shortest of the prefixes that
split them. In a task, suffixes fall into groups by a prefix that is lengthened until the group
is small enough (or the prefix is a whole window, when the group is one repeat). Groups are
taken together up to the same size, and the suffix tree of each such set is built: the leaves in
order, and between neighbours the depth of the node that parts them. Internal nodes at least as
deep as a window are repeats; those of which the leaves follow on different words are maximal
ones. The leaves of a maximal repeat that belong to other documents than its smallest one lose
all of its words. That covers every window: two places of a window, taken as far to the left and
to the right as they agree, are leaves below a maximal repeat.

Words are compared by 64-bit hashes. Null has no words. Rows without doc_id neither lose words
nor make others lose them. Rows that repeat a doc_id take part each with its own text: they lose
what smaller ids have and make larger ids lose what they have, but not one another.
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
from .suffix_dedup import remaining
from .windows import WORDS, Runs, bucket_count, rows_with_repeats

WINDOW = WORDS.window
PREFIXES = (1, 2, 4, 8, 16, 32, WINDOW)
GROUP_SUFFIXES = 1 << 18
LEVEL = 8


def _classes(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal keys together, and the class of each entry in that order."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), bool)
    for key in keys:
        fresh[1:] |= key[order][1:] != key[order][:-1]
    return order, np.cumsum(fresh)


def prefix_groups(tokens: np.ndarray, starts: np.ndarray, most: int = GROUP_SUFFIXES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sets of at most ``most`` suffixes (or one repeat), with the class of each one's prefix.

    Suffixes with a common prefix of the length that splits them are in one set and class.
    """
    waiting = np.arange(len(starts))
    prefix_of = np.zeros(len(starts), np.int64)
    sets: list[tuple[np.ndarray, np.ndarray]] = []
    for length in PREFIXES:
        if not len(waiting):
            break
        at = starts[waiting]
        order, classes = _classes(prefix_of[waiting], tx.token_run_hashes(tokens, at, at + length))
        members = waiting[order]
        sizes = np.bincount(classes)
        fits = (sizes <= most) | (length == WINDOW)
        small = fits[classes]
        sets.append((members[small], classes[small]))
        prefix_of[members] = classes
        waiting = members[~small]
    for members, classes in sets:
        if not len(members):
            continue
        # Whole classes together, up to the size of a set.
        cuts = np.flatnonzero(np.concatenate(([True], classes[1:] != classes[:-1])))
        begin = 0
        for cut, end in zip(cuts, [*cuts[1:], len(classes)], strict=True):
            if end - begin > most and cut > begin:
                yield members[begin:cut], classes[begin:cut]
                begin = cut
        if len(members) > begin:
            yield members[begin:], classes[begin:]


def suffix_tree(tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of the trees of all classes in order, and the depth of the node between each and the one before.

    The suffix of a leaf reaches from its start to its end. Neighbours that differ are settled;
    the others are compared ``LEVEL`` words further.
    """
    order = np.argsort(classes, kind="stable")
    common, lengths = np.zeros(len(order), np.int64), ends - starts
    tied = np.zeros(len(order), bool)
    tied[1:] = classes[order][1:] == classes[order][:-1]
    for depth in range(0, int(lengths.max(initial=0)), LEVEL):
        member = tied.copy()
        member[:-1] |= tied[1:]
        slots = np.flatnonzero(member)
        if not len(slots):
            break
        leaves, group = order[slots], np.cumsum(~tied)[slots]
        at = starts[leaves][:, None] + np.arange(depth, depth + LEVEL)
        words = np.where(at < ends[leaves][:, None], tokens[np.minimum(at, len(tokens) - 1)], np.uint64(0))
        inside = np.lexsort((*words.T[::-1], group))
        order[slots] = leaves[inside]
        words = words[inside]
        inner = np.flatnonzero(tied[slots])
        same = np.logical_and.accumulate(words[inner] == words[inner - 1], axis=1).sum(axis=1)
        common[slots[inner]] = depth + same
        tied[slots[inner]] = same == LEVEL
    common[1:] = np.minimum(common[1:], np.minimum(lengths[order][1:], lengths[order][:-1]))
    return order, common


def maximal_repeats(common: np.ndarray, left: np.ndarray, known: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Depth, first and last leaf of the internal nodes that are maximal repeats as long as a window.

    ``left`` is the word before each leaf, where it is ``known``; where it is not, it counts as
    different from all others. Nodes come by depth, those of one depth together.
    """
    differs = np.ones(len(common), bool)
    differs[1:] = (left[1:] != left[:-1]) | ~known[1:] | ~known[:-1]
    places = np.flatnonzero(common >= WINDOW)
    for depth in np.unique(common[places]):
        places = places[common[places] >= depth]
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(places) > 1)))
        node = (np.minimum.reduceat(common[places], cuts) == depth) & np.logical_or.reduceat(differs[places], cuts)
        yield int(depth), places[cuts][node] - 1, places[np.append(cuts[1:], len(places)) - 1][node]


def repeated_windows(runs: Runs) -> np.ndarray:
    """Which windows of the runs are also in one of a smaller document."""
    starts = tx.ranges(runs.before, runs.sizes)
    ends = np.repeat(runs.before + runs.sizes + WINDOW - 1, runs.sizes)
    owners = np.repeat(runs.docs, runs.sizes)
    known = starts > np.repeat(runs.before, runs.sizes)
    change = np.zeros(len(starts) + 1, np.int64)
    for members, classes in prefix_groups(runs.tokens, starts):
        order, common = suffix_tree(runs.tokens, starts[members], ends[members], classes)
        leaves = members[order]
        for depth, first, last in maximal_repeats(common, runs.tokens[starts[leaves] - 1], known[leaves]):
            if not len(first):
                continue
            sizes = last - first + 1
            below = leaves[tx.ranges(first, sizes)]
            smallest = np.repeat(np.minimum.reduceat(owners[below], np.cumsum(sizes) - sizes), sizes)
            # Windows of a run are neighbours, and a repeat ends within the run.
            lost = below[owners[below] > smallest]
            np.add.at(change, lost, 1)
            np.add.at(change, lost + (depth - WINDOW + 1), -1)
    return np.cumsum(change[:-1]) > 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and digest of all words of each text."""
    for batch in batches:
        found = [(text or b"").split() for text in batch.column("text").cast(pa.binary()).to_pylist()]
        numbers = pa.array([len(words) for words in found], pa.int64())
        digests = pa.array([hashlib.sha256(b" ".join(words)).hexdigest() for words in found], pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), numbers, digests], names=["doc_id", "text_key", "n_words", "whole_sha256"]
        )


def _remove(batches: Iterator[pa.RecordBatch], with_kept: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_key", "n_removed", "kept_sha256"] + ["kept"] * with_kept
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            rows = []
            for text, spans in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("spans").to_pylist(), strict=True):
                words = text.split()
                stays, gone, _ = remaining(len(words), spans)
                kept = b" ".join(words[i] for i in np.flatnonzero(stays))
                rows.append((gone, hashlib.sha256(kept).hexdigest(), kept.decode()))
            columns = [list(values) for values in zip(*rows, strict=True)][: 2 + with_kept]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), *map(pa.array, columns)], names=names)


def remove_repeated_words(documents: DataFrame, buckets: int | None = None, with_kept: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row.

    ``with_kept`` adds ``kept``, the words left joined by blanks, null where nothing was removed.
    ``buckets`` is the number of tasks that compare windows, by default ``bucket_count``.
    """
    spark = documents.sparkSession
    prepare_workers(spark)
    buckets = buckets or bucket_count(documents)
    rows = with_text_key(documents)
    touched = rows_with_repeats(rows, WORDS, 8, buckets, repeated_windows, "word")
    schema = "doc_id long, text_key long, n_removed long, kept_sha256 string" + ", kept string" * with_kept
    cleaned = touched.mapInArrow(partial(_remove, with_kept=with_kept), schema).dropDuplicates(["doc_id", "text_key"])
    base = rows.mapInArrow(_count, "doc_id long, text_key long, n_words long, whole_sha256 string")
    joined = base.join(cleaned.hint("merge"), ["doc_id", "text_key"], "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        *(["kept"] if with_kept else []),
    )
