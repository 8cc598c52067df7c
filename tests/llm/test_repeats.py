from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from cases import by_repr, frame, odd_documents, prose, sha, spaced, without_repeats
from pyspark.sql import functions as F

from stratamart.llm import suffix_dedup, texts as tx, windows
from stratamart.llm.shared import with_text_key
from stratamart.llm.substring_dedup import maximal_repeats, prefix_groups, remove_repeated_words, repeated_windows, suffix_tree
from stratamart.llm.suffix_dedup import remove_repeated_bytes


def raw(text):
    return (text or "").encode()


def passages(number, ids=61):
    """Documents that share passages of many lengths, cut anywhere; with few ids, each has many texts."""
    pick = random.Random(number)
    sources = [prose(number * 50 + at, 150, 3000) for at in range(6)]
    rows = []
    for doc_id in range(60):
        parts = []
        for _ in range(pick.randrange(4)):
            source = pick.choice(sources)
            begin = pick.randrange(len(source) - 10)
            parts += [source[begin : begin + pick.randrange(20, 500)], prose(doc_id, pick.randrange(12), 3000)]
        rows.append((doc_id * 7 % ids, pick.choice([" ", "", "\n"]).join(parts)))
    return rows


@pytest.mark.parametrize("rows", [odd_documents(), passages(1), passages(2), passages(3, ids=5), passages(4, ids=2) * 2])
def test_bytes(spark, rows):
    found = remove_repeated_bytes(frame(spark, rows), with_kept=True).collect()
    wanted = [(i, len(own), len(own) - len(kept), runs, sha(bytes(kept)), bytes(kept)) for i, own, kept, runs in without_repeats(rows, raw)]
    assert by_repr([(*tuple(row)[:5], bytes(row.kept)) for row in found]) == by_repr(wanted)


@pytest.mark.parametrize("rows", [odd_documents(), passages(1), passages(2), passages(3, ids=5), passages(4, ids=2) * 2])
def test_words(spark, rows):
    found = remove_repeated_words(frame(spark, rows)).collect()
    wanted = [(i, len(own), len(own) - len(kept), sha(b" ".join(kept))) for i, own, kept, _ in without_repeats(rows, spaced)]
    assert by_repr(map(tuple, found)) == by_repr(wanted)


def test_an_id_with_two_texts(spark):
    """Both lose what a smaller id has, and what only one of them has goes from larger ids."""
    text, other = prose(3, 100, 500), prose(8, 100, 500)
    rows = frame(spark, [(1, text), (2, text), (2, f"x {text} {other}"), (3, other), (3, f"{text} y {other}"), (4, "short")])
    for found in (remove_repeated_bytes(rows), remove_repeated_words(rows)):
        removed = sorted((row.doc_id, row.n_removed > 0) for row in found.collect())
        assert removed == [(1, False), (2, True), (2, True), (3, True), (3, True), (4, False)]


def test_a_row_that_is_a_third_of_all(spark):
    """Spans of rows that repeat doc_id and text do not pile up with their number."""
    text = prose(3, 100, 500)
    rows = frame(spark, [(1, text), *[(7, f"{text} {prose(8, 80, 500)}")] * 900, *((at, prose(at, 60, 500)) for at in range(10, 1800))])
    named = with_text_key(rows).repartition(40)
    found = windows.rows_with_repeats(named, windows.BYTES, 1, 8, suffix_dedup.repeated_windows, "third")
    assert [(row.n, row.most < 30) for row in found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.size("spans")).alias("most")).collect()] == [(900, True)]
    assert {row.n_removed for row in remove_repeated_bytes(rows).where("doc_id = 7").collect()} == {len(raw(text))}


def test_empty_tables(spark):
    assert remove_repeated_bytes(frame(spark, [])).collect() == []
    assert remove_repeated_words(frame(spark, [])).collect() == []


def test_suffix_order_and_longest_matches():
    pick = random.Random(4)
    block = bytes(pick.choice(b"ab") for _ in range(200))
    data = b"".join(block[a : a + pick.randrange(60, 140)] for a in [pick.randrange(60) for _ in range(20)])
    tokens = np.frombuffer(data, np.uint8)
    starts = np.arange(len(data) - 50 + 1)
    order, common = suffix_dedup.suffix_order(tokens, starts)
    cut = [data[s : s + 50] for s in starts]
    assert order.tolist() == sorted(range(len(starts)), key=lambda s: (cut[s], s))

    def shared(x, y):
        return next((at for at in range(50) if x[at] != y[at]), 50)

    assert common[1:].tolist() == [shared(cut[a], cut[b]) for a, b in zip(order, order[1:], strict=False)]
    owners = starts // 90
    lengths = [max((shared(cut[t], cut[s]) for t in starts if owners[t] < owners[s]), default=0) for s in starts]
    for at_least in (1, 20, 50):
        longest = np.zeros(len(starts), np.int64)
        longest[order] = suffix_dedup.longest_previous(common, owners[order], at_least)
        assert longest.tolist() == [length if length >= at_least else 0 for length in lengths]


def word_runs(seed, number, letters):
    """Runs cut from one block of few words, with the smallest documents first."""
    pick = np.random.default_rng(seed)
    block = tx.mix(pick.integers(1, letters + 1, 300).astype(np.uint64))
    lengths = pick.integers(50, 90, number)
    parts = [block[a : a + length] for a, length in zip(pick.integers(0, 180, number), lengths, strict=True)]
    docs = np.sort(pick.integers(0, number // 2, number))
    return windows.Runs(docs, np.zeros(number, np.int64), lengths - 49, np.concatenate(parts), np.cumsum(lengths) - lengths)


@pytest.mark.parametrize("most", [4, 40, 10**6])
@pytest.mark.parametrize("letters", [1, 2, 1000])
def test_maximal_repeats_of_prefix_groups(most, letters):
    """Equal to the plain definition: all leaves that share a sequence that cannot be made longer on either side."""
    runs = word_runs(5, 14, letters)
    starts = tx.ranges(runs.before, runs.sizes)
    ends = np.repeat(runs.before + runs.sizes + 49, runs.sizes)
    begins = set(runs.before.tolist())
    left = [None if s in begins else int(runs.tokens[s - 1]) for s in starts]
    found = set()
    for members, classes in prefix_groups(runs.tokens, starts, most):
        order, common = suffix_tree(runs.tokens, starts[members], ends[members], classes)
        leaves = members[order]
        known = np.array([left[leaf] is not None for leaf in leaves])
        for depth, first, last in maximal_repeats(common, runs.tokens[starts[leaves] - 1], known):
            for a, b in zip(first, last, strict=True):
                found.add((depth, frozenset(leaves[a : b + 1].tolist())))
    by_sequence = {}
    for at, (s, e) in enumerate(zip(starts, ends, strict=True)):
        for length in range(50, e - s + 1):
            by_sequence.setdefault((length, runs.tokens[s : s + length].tobytes()), []).append(at)
    wanted = set()
    for (length, _), places in by_sequence.items():
        after = [None if starts[at] + length == ends[at] else int(runs.tokens[starts[at] + length]) for at in places]
        before = [left[at] for at in places]
        if len(places) > 1 and all(None in side or len(set(side)) > 1 for side in (after, before)):
            wanted.add((length, frozenset(places)))
    assert found == wanted and (letters == 1000 or found)


@pytest.mark.parametrize("letters", [1, 2, 3, 1000])
def test_repeated_windows_of_runs(letters):
    for seed in range(6):
        runs = word_runs(seed, 16, letters)
        starts, owners = tx.ranges(runs.before, runs.sizes), np.repeat(runs.docs, runs.sizes)
        cut = [runs.tokens[s : s + 50].tobytes() for s in starts]
        first = {}
        for window, owner in zip(cut, owners, strict=True):
            first[window] = min(first.get(window, owner), owner)
        wanted = [bool(first[window] < owner) for window, owner in zip(cut, owners, strict=True)]
        assert repeated_windows(runs).tolist() == wanted
        in_bytes = windows.Runs(runs.docs, runs.places, runs.sizes, (runs.tokens % np.uint64(251)).astype(np.uint8), runs.before)
        if letters <= 3:
            assert suffix_dedup.repeated_windows(in_bytes).tolist() == wanted


def test_packing():
    values = np.array([5, -3, 10**15, 0], np.int64)
    assert windows.unpack(windows.pack(values), np.int64).tolist() == values.tolist()


def sent_windows(texts):
    """What a slice of documents sends to one bucket, all anchors counting as shared."""
    first = np.cumsum([0, *(len(raw(text)) for text in texts)])
    data = np.frombuffer(raw("".join(texts)), np.uint8)
    _, places, _ = windows.anchors(windows.BYTES, tx.BYTE_VALUES[data], first)
    lists = [sorted({int(at - first[row]) for at in places if first[row] <= at < first[row + 1]}) for row in range(len(texts))]
    ids = pa.array(range(len(texts)), pa.int64())
    columns = {"doc_id": ids, "variant": pa.array([0] * len(texts), pa.int64()), "text_key": ids, "text": pa.array(texts)}
    batch = pa.RecordBatch.from_pydict({**columns, "places": pa.array(lists, pa.list_(pa.int64()))})
    return [*windows._send_windows(iter([batch]), windows.BYTES, 1)]


def test_windows_are_judged_in_parts(monkeypatch):
    """A task compares what it has anchor by anchor, a bounded number of tokens at a time."""
    common = [prose(at, 60, 3000) for at in range(6)]
    texts = [f"{prose(50 + at, 20, 3000)} {common[at % 6]} {prose(80 + at, 20, 3000)} {common[(at + 1) % 6]}" for at in range(12)]
    sent, found, largest = sent_windows(texts), {}, {}
    for most in (1 << 40, 1000, 1):
        monkeypatch.setattr(windows, "PART_TOKENS", most)
        sizes = []

        def judge(runs, sizes=sizes):
            sizes.append(len(runs.tokens))
            return suffix_dedup.repeated_windows(runs)

        gone = [set() for _ in texts]
        for part in windows._settle_windows(iter(sent), windows.BYTES, 1, judge):
            for doc, _, start, stop in zip(*(column.to_pylist() for column in part.columns), strict=True):
                gone[doc].update(range(start, stop))
        found[most], largest[most] = gone, max(sizes)
    wanted = without_repeats(list(enumerate(texts)), raw)
    for gone in found.values():
        assert [len(places) for places in gone] == [len(own) - len(kept) for _, own, kept, _ in wanted]
    assert found[1000] == found[1 << 40] == found[1]
    assert largest[1] <= largest[1000] < 2000 < largest[1 << 40]


def test_buckets_follow_the_text(spark, monkeypatch):
    rows = frame(spark, [(1, "ä" * 50), (2, None), (3, "b" * 900)])
    assert windows.bucket_count(rows) == 8
    assert windows.bucket_count(rows.limit(0)) == 8
    monkeypatch.setattr(windows, "BUCKET_BYTES", 99)
    assert windows.bucket_count(rows) == 11
