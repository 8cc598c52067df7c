"""Windows that several documents share, found through the grams that stand for them.

A window is a fixed number of consecutive tokens. Of the grams (shorter runs of tokens) inside
a window the one with the smallest hash is its anchor. The anchor follows from the window's
content alone, so equal windows have equal anchors at the same place. Neighbouring windows
mostly have the same anchor, which makes anchors few.

``shared_anchors`` finds the anchors that documents with different ids have, and with these the
documents and windows that can be shared at all. ``anchored_windows`` then brings the contents
of these windows together by anchor, so that a task can compare all that can be equal.

Rows travel packed: one row per map slice and bucket holds many entries in binary columns, and
what a slice can settle by itself does not travel. An anchor or a run of windows that many
documents of a slice have is sent once for the slice, whichever share of all documents has it.

Every row takes part. Rows that repeat a doc_id with other texts are told apart by ``text_key``:
anchors carry a few bits of it (``tag``), which is enough where places too many do no harm, and
windows a ``variant``, which is 0 but for such rows and so packs to nothing. Rows that repeat both
are one row, of which a slice sends one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx
from .shared import shuffle_partitions, stored

#: An entry that only says that documents of one slice share its hash.
SHARED_ALREADY = -1
_HASH_BYTES = 5
TAG_BITS = 16
#: A task judges windows in parts of about so many tokens, whatever the size of its bucket.
PART_TOKENS = 1 << 20
#: A bucket gets what is shared of about so much text.
BUCKET_BYTES = 1 << 24


@dataclass(frozen=True)
class Unit:
    """What windows consist of: ``read`` gives slices of tokens, their hashes, and tokens before each text."""

    window: int
    gram: int
    read: Callable[[pa.Array], Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]]


def read_bytes(column: pa.Array):
    for first_row, last_row, data, offsets in tx.sliced(column):
        yield first_row, last_row, data, tx.BYTE_VALUES[data], offsets


def read_words(column: pa.Array):
    for first_row, last_row, data, offsets in tx.sliced(column):
        starts, ends, first = tx.words(data, offsets, tx.NOT_SPACE)
        hashes = tx.span_hashes(data, starts, ends)
        yield first_row, last_row, hashes, hashes, first


BYTES = Unit(50, 16, read_bytes)
WORDS = Unit(50, 10, read_words)


def anchors(unit: Unit, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of windows, the anchor's position of each, and hashes of the grams everywhere."""
    grams = tx.run_values(values, unit.gram)
    best = tx.sliding_argmin(grams, unit.window - unit.gram + 1)
    starts = tx.run_starts(first, unit.window)
    return starts, best[starts], grams


def _changes(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


def pack(values: np.ndarray) -> bytes:
    """Compressed differences of whole numbers."""
    return zstandard.compress(np.diff(values, prepend=values.dtype.type(0)).tobytes(), 1)


def unpack(packed: bytes, dtype) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(packed), dtype), dtype=dtype)


def _by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(buckets, kind="stable")
    cuts = _changes(buckets[order])
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(buckets[order[a]]), order[a:b]


def _numbers(batch: pa.RecordBatch, name: str, first_row: int, last_row: int) -> np.ndarray:
    return batch.column(name).slice(first_row, last_row - first_row).to_numpy(zero_copy_only=False)


def _once(keys: np.ndarray) -> np.ndarray:
    """Which entries are the first with their key."""
    out = np.zeros(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = True
    return out


ANCHOR_ROWS = "bucket int, hashes binary, docs binary, tags binary, places binary"
_FOUND = pa.schema([("bucket", pa.int32()), *((name, pa.binary()) for name in ("hashes", "docs", "tags", "places"))])


def _send_anchors(batches: Iterator[pa.RecordBatch], unit: Unit, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows for the buckets, and rows without hashes for what a slice knows to be shared."""
    for batch in batches:
        for first_row, last_row, _, values, first in unit.read(batch.column("text")):
            ids, keys = (_numbers(batch, name, first_row, last_row) for name in ("doc_id", "text_key"))
            once = _once(keys)
            _, places, grams = anchors(unit, values, first)
            del values
            places = places[_changes(places)]
            rows = np.searchsorted(first, places, "right") - 1
            places, rows = places[once[rows]], rows[once[rows]]
            if not len(places):
                continue
            hashes, docs, places = tx.mix(grams[places]), ids[rows], places - first[rows]
            tags = (keys & ((1 << TAG_BITS) - 1)).astype(np.uint16)[rows]
            order = np.argsort(hashes, kind="stable")
            runs = _changes(hashes[order])
            lowest, highest = np.minimum.reduceat(docs[order], runs), np.maximum.reduceat(docs[order], runs)
            shared = np.zeros(len(hashes), bool)
            shared[order] = np.repeat(lowest != highest, np.diff(np.append(runs, len(order))))

            out = {name: [] for name in _FOUND.names}

            def put(bucket, hash_bytes, entries, entry_places, out=out):
                row = (bucket, hash_bytes, pack(docs[entries]), pack(tags[entries]), pack(entry_places))
                for name, value in zip(_FOUND.names, row, strict=True):
                    out[name].append(value)

            if shared.any():
                # Dealt out by a number of the slice, as these rows need no company.
                put(int(hashes[0] % np.uint64(buckets)), b"", shared, places[shared].astype(np.int64))
            once = order[runs[lowest != highest]]
            alone = np.flatnonzero(~shared)
            sent = np.concatenate((alone, once))
            sent_places = np.concatenate((places[alone], np.full(len(once), SHARED_ALREADY))).astype(np.int64)
            for bucket, picked in _by_bucket((hashes[sent] % np.uint64(buckets)).astype(np.int64)):
                high = (hashes[sent[picked]] >> np.uint64(64 - 8 * _HASH_BYTES)).astype("<u8")
                put(bucket, high.view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES].tobytes(), sent[picked], sent_places[picked])
            yield pa.RecordBatch.from_pydict(out, _FOUND)


def _settle_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents and places of all anchors that documents with different ids have."""
    held: list[tuple[np.ndarray, ...]] = []
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int32()), ("place", pa.int64())])

    def found(docs, tags, places):
        return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(tags.astype(np.int32)), pa.array(places)], schema=schema)

    for batch in batches:
        for bucket, hashes, docs, tags, places in zip(*(batch.column(name).to_pylist() for name in _FOUND.names), strict=True):
            docs, tags, places = unpack(docs, np.int64), unpack(tags, np.uint16), unpack(places, np.int64)
            if not hashes:
                yield found(docs, tags, places)
                continue
            wide = np.zeros((len(docs), 8), np.uint8)
            wide[:, :_HASH_BYTES] = np.frombuffer(hashes, np.uint8).reshape(-1, _HASH_BYTES)
            wide[:, _HASH_BYTES : _HASH_BYTES + 2] = np.array([bucket & 0xFFFF], "<u2").view(np.uint8)
            held.append((wide.view("<u8")[:, 0], docs, tags, places))
    if not held:
        return
    hashes, docs, tags, places = (np.concatenate(part) for part in zip(*held, strict=True))
    held.clear()
    order = np.argsort(hashes)
    runs = _changes(hashes[order])
    sizes = np.diff(np.append(runs, len(order)))
    docs, tags, places = docs[order], tags[order], places[order]
    shared = np.minimum.reduceat(docs, runs) != np.maximum.reduceat(docs, runs)
    shared |= np.minimum.reduceat(places, runs) == SHARED_ALREADY
    wanted = np.repeat(shared, sizes) & (places != SHARED_ALREADY)
    yield found(docs[wanted], tags[wanted], places[wanted])


def shared_anchors(documents: DataFrame, unit: Unit, buckets: int) -> DataFrame:
    """``doc_id, tag, places``: the places of each row's anchors that other documents have too.

    ``documents`` has ``doc_id, text, text_key``, none of the ids null. Sets of places, unlike lists,
    do not grow with the number of times that a row is repeated.
    """
    rows = documents.select("doc_id", "text", "text_key").mapInArrow(partial(_send_anchors, unit=unit, buckets=buckets), ANCHOR_ROWS)
    dealt = rows.repartitionById(buckets, F.col("bucket"))
    found = dealt.mapInArrow(_settle_anchors, "doc_id long, tag int, place long")
    return found.groupBy("doc_id", "tag").agg(F.collect_set("place").alias("places"))


_PARTS = ("docs", "variants", "places", "sizes", "hashes", "anchors", "contents")
WINDOW_ROWS = "bucket int, " + ", ".join(f"{name} binary" for name in _PARTS)
_SENT = pa.schema([("bucket", pa.int32()), *((name, pa.binary()) for name in _PARTS)])


def _send_windows(batches: Iterator[pa.RecordBatch], unit: Unit, buckets: int) -> Iterator[pa.RecordBatch]:
    """Runs of windows with one shared anchor, by the anchor's bucket.

    Where documents of one slice have the same run, the smallest id speaks for all: the others'
    windows go out as settled, which are rows without contents. Where rows of that id repeat a run,
    its contents go out with the first of them.
    """
    for batch in batches:
        lists = batch.column("places")
        for first_row, last_row, tokens, values, first in unit.read(batch.column("text")):
            ids, variants, keys = (_numbers(batch, name, first_row, last_row) for name in ("doc_id", "variant", "text_key"))
            wanted = lists.slice(first_row, last_row - first_row)
            rows = np.repeat(np.arange(last_row - first_row), wanted.value_lengths().to_numpy(zero_copy_only=False))
            marked = np.zeros(len(tokens) + 1, bool)
            spots = (first[rows] + wanted.flatten().to_numpy(zero_copy_only=False))[_once(keys)[rows]]
            # Rows of one id and tag have the places of all of them.
            marked[np.minimum(spots, len(tokens))] = True
            starts, places, grams = anchors(unit, values, first)
            keep = marked[places] if len(places) else np.zeros(0, bool)
            starts, places = starts[keep], places[keep]
            if not len(starts):
                continue
            # A run ends where the anchor changes or a window is left out.
            begins = _changes(places)
            sizes = np.diff(np.append(begins, len(starts)))
            begin, anchor = starts[begins], places[begins]
            owner = np.searchsorted(first, begin, "right") - 1
            docs = ids[owner]
            ends = begin + sizes + unit.window - 1
            content = tx.token_run_hashes(values, begin, ends)
            order = np.lexsort((docs, content))
            runs = _changes(content[order])
            smallest = np.empty(len(docs), np.int64)
            smallest[order] = np.repeat(docs[order][runs], np.diff(np.append(runs, len(order))))
            later = docs > smallest
            out = {name: [] for name in _SENT.names}

            mixed = tx.mix(grams[anchor])
            key, short = mixed % np.uint64(buckets), (mixed >> np.uint64(32)).astype("<u4")

            def put(bucket, picked, contents, out=out):
                entry = [bucket, pack(docs[picked]), pack(variants[owner[picked]]), pack((begin - first[owner])[picked]), pack(sizes[picked])]
                marks = [content[picked].tobytes(), short[picked].tobytes()] if contents else [b"", b""]
                for name, value in zip(_SENT.names, [*entry, *marks, contents], strict=True):
                    out[name].append(value)

            if later.any():
                put(int(key[0]), np.flatnonzero(later), b"")
            sent = np.flatnonzero(~later)
            raw, width = tokens.tobytes(), tokens.itemsize
            for bucket, picked in _by_bucket(key[sent].astype(np.int64)):
                picked = sent[picked]
                full = picked[_once(content[picked])]
                parts = [raw[a:b] for a, b in zip((begin[full] * width).tolist(), (ends[full] * width).tolist(), strict=True)]
                put(bucket, picked, zstandard.compress(b"".join(parts), 1))
            yield pa.RecordBatch.from_pydict(out, _SENT)


@dataclass
class Runs:
    """Distinct runs of windows with the smallest id that has them, in ascending order of ids."""

    docs: np.ndarray
    places: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray
    before: np.ndarray


def _settle_windows(batches: Iterator[pa.RecordBatch], unit: Unit, width: int, judge: Callable[[Runs], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Which tokens go: ``doc_id, variant, start, stop`` spans."""
    schema = pa.schema([(name, pa.int64()) for name in ("doc_id", "variant", "start", "stop")])
    held: list[tuple] = []
    packed: list[bytes] = []

    def spans(docs, variants, places, sizes):
        """Windows of consecutive starts cover one span; spans of a row that touch are joined."""
        order = np.lexsort((places, variants, docs) if variants.any() else (places, docs))
        docs, variants = docs[order], variants[order]
        start, stop = places[order], (places + sizes + unit.window - 1)[order]
        if len(docs):
            # Within a row, stops can only fall behind by repeated entries.
            fresh = np.concatenate(([True], (docs[1:] != docs[:-1]) | (variants[1:] != variants[:-1]) | (start[1:] > stop[:-1])))
            at = np.flatnonzero(fresh)
            docs, variants, start, stop = docs[at], variants[at], start[at], np.maximum.reduceat(stop, at)
        return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(variants), pa.array(start), pa.array(stop)], schema=schema)

    for batch in batches:
        for _, *numbers, hashes, short, contents in zip(*(batch.column(name).to_pylist() for name in _SENT.names), strict=True):
            entries = [unpack(values, np.int64) for values in numbers]
            if not contents:
                yield spans(*entries)
            else:
                held.append((*entries, np.frombuffer(hashes, np.uint64), np.frombuffer(short, "<u4")))
                packed.append(contents)
    if not held:
        return
    counts = [len(part[0]) for part in held]
    first_of_row = np.concatenate([_once(part[4]) for part in held])
    docs, variants, places, sizes, content, short = (np.concatenate(part) for part in zip(*held, strict=True))
    held.clear()
    order = np.lexsort((docs, content))
    runs = _changes(content[order])
    repeats = np.diff(np.append(runs, len(order)))
    smallest = np.empty(len(docs), np.int64)
    smallest[order] = np.repeat(docs[order[runs]], repeats)
    later = docs > smallest
    yield spans(docs[later], variants[later], places[later], sizes[later])

    # One entry for each distinct run, and of these the ones whose anchor another one has too. It is
    # the first of its packed row, as equal entries keep their order, and so has contents.
    unique = order[runs]
    by_anchor = np.argsort(short[unique], kind="stable")
    groups = _changes(short[unique][by_anchor])
    group_sizes = np.diff(np.append(groups, len(unique)))
    unique = unique[by_anchor[np.repeat(group_sizes > 1, group_sizes)]]
    if not len(unique):
        return
    # Equal windows have equal anchors, so a part with all runs of its anchors is judged by itself.
    lengths = sizes + unit.window - 1
    parts = _parts(short[unique], lengths[unique], PART_TOKENS)
    by_part = np.lexsort((docs[unique], parts))
    unique, parts = unique[by_part], parts[by_part]
    # Every place of a first document takes the result of its run.
    number = np.empty(len(docs), np.int64)
    number[order] = np.repeat(np.arange(len(runs)), repeats)
    position = np.full(len(runs), -1)
    position[number[unique]] = np.arange(len(unique))
    source_of = position[number]
    first_ones = np.flatnonzero(~later & (source_of >= 0))
    first_ones = first_ones[np.argsort(parts[source_of[first_ones]], kind="stable")]
    source_of = source_of[first_ones]
    del content, short, order, runs, repeats, smallest, later, number, position, by_anchor, groups, group_sizes, by_part

    pool, at = _contents_of(unique, packed, counts, lengths, np.where(first_of_row, lengths, 0), width)
    cuts = _changes(parts)
    served = np.searchsorted(parts[source_of], parts[cuts])
    for begin, end, a, b in zip(cuts, [*cuts[1:], len(unique)], served, [*served[1:], len(first_ones)], strict=True):
        own, mine, source = unique[begin:end], first_ones[a:b], source_of[a:b] - begin
        tokens, before = pool[tx.ranges(at[begin:end], lengths[own])], np.cumsum(lengths[own]) - lengths[own]
        repeated = judge(Runs(docs[own], places[own], sizes[own], tokens, before))
        window_at = np.cumsum(sizes[own]) - sizes[own]
        flags = repeated[tx.ranges(window_at[source], sizes[mine])]
        which = np.repeat(mine, sizes[mine])[flags]
        starts = tx.ranges(places[mine], sizes[mine])[flags]
        yield spans(docs[which], variants[which], starts, np.ones(len(which), np.int64))


def _parts(anchors: np.ndarray, tokens: np.ndarray, most: int) -> np.ndarray:
    """A number for each entry of ascending anchors; equal ones share it, and about ``most`` tokens do."""
    groups = _changes(anchors)
    before = np.cumsum(tokens) - tokens
    return np.repeat(before[groups] // most, np.diff(np.append(groups, len(anchors))))


def _contents_of(
    picked: np.ndarray, packed: list[bytes], entries: list[int], lengths: np.ndarray, sent: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of some entries, and where those of each begin.

    Of ``lengths`` a packed row has ``sent``. Packed rows are taken from their list one by one.
    """
    wanted = np.zeros(len(lengths), bool)
    wanted[picked] = True
    kept = np.where(wanted, lengths, 0)
    pool, first, filled = np.empty(int(kept.sum()), f"u{width}"), 0, 0
    packed.reverse()
    for number in entries:
        contents = packed.pop()
        own = sent[first : first + number]
        some = wanted[first : first + number]
        if some.any():
            tokens = np.frombuffer(zstandard.decompress(contents), f"u{width}")
            found = tokens[tx.ranges((np.cumsum(own) - own)[some], own[some])]
            pool[filled : filled + len(found)] = found
            filled += len(found)
        first += number
    return pool, (np.cumsum(kept) - kept)[picked]


def repeated_spans(candidates: DataFrame, unit: Unit, width: int, buckets: int, judge: Callable[[Runs], np.ndarray]) -> DataFrame:
    """``doc_id, variant, spans``: the tokens of each row in windows that a smaller id has too.

    ``candidates`` has ``doc_id, variant, text_key, text, places``; ``judge`` tells for every window of
    distinct runs whether it is also in one of a smaller id.
    """
    rows = candidates.select("doc_id", "variant", "text_key", "text", "places")
    sent = rows.mapInArrow(partial(_send_windows, unit=unit, buckets=buckets), WINDOW_ROWS)
    dealt = sent.repartitionById(buckets, F.col("bucket"))
    settle = partial(_settle_windows, unit=unit, width=width, judge=judge)
    found = dealt.mapInArrow(settle, "doc_id long, variant long, start long, stop long")
    return found.groupBy("doc_id", "variant").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def bucket_count(rows: DataFrame) -> int:
    """As many buckets as shuffle partitions, or more where these would have over ``BUCKET_BYTES``.

    A task holds the shared text of its bucket, so its memory is that of a bucket of this size.
    """
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(shuffle_partitions(rows.sparkSession), -(-total // BUCKET_BYTES))


def rows_with_repeats(
    documents: DataFrame, unit: Unit, width: int, buckets: int, judge: Callable[[Runs], np.ndarray], name: str
) -> DataFrame:
    """``doc_id, text_key, text, spans`` of the rows that have a window that a smaller id has too.

    ``documents`` has ``doc_id, text, text_key``. Rows that repeat all of it come as often as they are.
    """
    named = documents.where("doc_id IS NOT NULL")
    tag = F.col("text_key").bitwiseAND((1 << TAG_BITS) - 1).cast("int")
    firsts = named.groupBy("doc_id").agg(F.min("text_key").alias("first_key"))
    firsts = firsts.select("doc_id", "first_key", F.col("first_key").bitwiseAND((1 << TAG_BITS) - 1).cast("int").alias("tag"))
    marked = shared_anchors(named, unit, buckets).join(firsts.hint("merge"), ["doc_id", "tag"], "left").hint("merge")
    variant = F.when(F.col("text_key") == F.col("first_key"), F.lit(0)).otherwise(F.col("text_key"))
    found = named.withColumn("tag", tag).join(marked, ["doc_id", "tag"])
    candidates = stored(found.select("doc_id", variant.alias("variant"), "text_key", "text", "places"), f"{name}_candidates")
    spans = stored(repeated_spans(candidates, unit, width, buckets, judge), f"{name}_spans")
    return candidates.drop("places").join(spans.hint("merge"), ["doc_id", "variant"]).drop("variant")
