"""License scans by MinHash bands over overlapping windows (operator 1).

Words are those of plain text (ASCII letters and digits and all other characters), lower-cased
in ASCII; sets hold the distinct ``SHINGLE``-word shingles. A template of m words belongs to the
smallest window size that is at least 2 m. Windows of each size start every half size, so an
occurrence of a template always lies inside some window of its size, which is at most four
times as long as the template.

A template matches where a window has ``CONTAINED`` of its shingles, or all of them if they are
fewer than ``SHORT`` (notices of that size differ from others by a word). Such a window has at least
``J = 0.8 t / (w + 0.2 t) >= 0.19`` of their union in common with it, where no shingle of the
template repeats; the long texts repeat so many that J is 0.125 at worst. Bands of one minimum each
collide with probability ``1 - (1 - J) ** 64 >= 0.999998``, for these texts 0.9998; rows of more minima would lose more
of these windows than they save, because a chance collision already takes a shared shingle. The
minima of a large window are those of the smaller ones in it, so all sizes cost one pass.
Retrieved pairs are verified by exact containment.

Null and empty texts match nothing. A template without words matches nothing, one shorter than
a shingle only matches texts that are nothing else. Window sizes go on doubling up to the longest
template. Templates travel in the function of the tasks, which Spark broadcasts by its measured size.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx
from .shared import prepare_workers

SHINGLE = 2
CONTAINED, SHORT = 0.8, 10
BANDS = 64
#: The smallest window; sizes double from there.
SMALLEST = 8
#: Up to so many minima are compared one by one, more are looked up.
FEW = 16

# Phrases, headers and openings by their SPDX identifiers, or a word where there is none.
# Whole texts and notices lie in ``license_texts``.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under
        the License.""",
    "MIT": "Released under the MIT License",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
        ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
        is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD-text": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer.""",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation""",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work",
    "all-rights-reserved": "All rights reserved",
}


def whole_texts() -> dict[str, str]:
    """The texts and notices of ``license_texts``, whole, by file name."""
    files = resources.files(__package__).joinpath("license_texts").iterdir()
    return {file.name[: -len(".txt")]: file.read_text("utf-8") for file in files if file.name.endswith(".txt")}


def _shingles(hashes: np.ndarray) -> np.ndarray:
    return tx.run_hashes(hashes, min(SHINGLE, max(len(hashes), 1)))


class Templates:
    """Templates by window size: their shingles, and for each band the minima that lead to them."""

    def __init__(self, templates: Mapping[str, str]):
        self.factors = tx.numbered(9000, BANDS) | np.uint64(1)
        self.names = sorted(templates)
        self.sets: dict[str, np.ndarray] = {}
        self.by_size: dict[int, list[str]] = {}
        for name in self.names:
            data, offsets = tx.utf8(pa.array([templates[name]]))
            lower = tx.LOWER[data]
            starts, ends, _ = tx.words(lower, offsets, tx.PLAIN_WORD)
            if not len(starts):
                continue
            size = max(SMALLEST, 1 << (2 * len(starts) - 1).bit_length())
            self.sets[name] = np.unique(_shingles(tx.span_hashes(lower, starts, ends)))
            self.by_size.setdefault(size, []).append(name)
        self.keys = {
            size: np.array([[(self.sets[name] * factor).min() for name in names] for factor in self.factors])
            for size, names in self.by_size.items()
        }
        self.order = {size: np.argsort(keys, axis=1) for size, keys in self.keys.items()}
        self.largest = max(self.by_size, default=SMALLEST)


def _values(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A shingle for each word: the one it begins, or for the last word of a text the one before."""
    out = np.append(_shingles(hashes), np.uint64(0))[: len(hashes)] if len(hashes) > 1 else tx.run_hashes(hashes, 1)
    last = first[1:][np.diff(first) > 0] - 1
    alone = last[np.isin(last, first[:-1])]
    several = np.setdiff1d(last, alone, assume_unique=True)
    out[several] = out[several - 1]
    out[alone] = tx.run_hashes(hashes[alone], 1)
    return out


def _levels(first: np.ndarray, largest: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each half size where blocks begin in those of the level below, where in the words, and which have a next one in their text."""
    half = SMALLEST // 2
    out, below, step = [], first, half
    while half <= largest // 2:
        counts = -(-np.diff(below) // step)
        begins = tx.ranges(np.zeros(len(counts), np.int64), counts) * step + np.repeat(below[:-1], counts)
        at = tx.ranges(np.zeros(len(counts), np.int64), counts) * half + np.repeat(first[:-1], counts)
        followed = np.ones(len(begins), bool)
        ends = np.cumsum(counts)
        followed[ends[counts > 0] - 1] = False
        out.append((half, begins, at, followed))
        below, step, half = np.concatenate(([0], ends)), 2, 2 * half
    return out


def _collisions(windows: np.ndarray, keys: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, int]]:
    """Window and template numbers of equal minima; ``order`` sorts the keys."""
    if len(keys) <= FEW:
        for number, key in enumerate(keys):
            yield from ((window, number) for window in np.flatnonzero(windows == key))
        return
    ordered = keys[order]
    low, high = np.searchsorted(ordered, windows, "left"), np.searchsorted(ordered, windows, "right")
    hits = np.flatnonzero(high > low)
    counts = (high - low)[hits]
    yield from zip(np.repeat(hits, counts), order[tx.ranges(low[hits], counts)], strict=True)


def _retrieved(values: np.ndarray, first: np.ndarray, templates: Templates) -> set[tuple[int, int, int]]:
    """Window size, first word and template number, where a band collides."""
    out: set[tuple[int, int, int]] = set()
    levels = _levels(first, templates.largest)
    for band, factor in enumerate(templates.factors):
        blocks = values * factor
        for half, begins, at, followed in levels:
            blocks = np.minimum.reduceat(blocks, begins)
            keys = templates.keys.get(2 * half)
            if keys is None:
                continue
            # A window is two neighbouring blocks; the last block of a text is one by itself.
            windows = blocks.copy()
            np.minimum(blocks[:-1], blocks[1:], out=windows[:-1], where=followed[:-1])
            found = _collisions(windows, keys[band], templates.order[2 * half][band])
            out.update((2 * half, int(at[window]), int(number)) for window, number in found)
    return out


def scan_words(hashes: np.ndarray, first: np.ndarray, templates: Templates) -> list[dict[str, tuple[float, int]]]:
    """For each text the matched templates with the best containment and the first word of its window."""
    best: list[dict[str, tuple[float, int]]] = [{} for _ in range(len(first) - 1)]
    if not len(hashes):
        return best
    values = _values(hashes, first)
    for size, start, number in sorted(_retrieved(values, first, templates)):
        text = int(np.searchsorted(first, start, "right")) - 1
        name = templates.by_size[size][number]
        wanted = templates.sets[name]
        window = values[start : min(start + size, first[text + 1])]
        share = np.isin(wanted, window).sum() / len(wanted)
        if share >= (CONTAINED if len(wanted) >= SHORT else 1) and share > best[text].get(name, (0.0, 0))[0]:
            best[text][name] = (float(share), start - int(first[text]))
    return best


def _scan(batches: Iterator[pa.RecordBatch], templates: Templates) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("first_word", pa.int64())]))
    for batch in batches:
        for first_row, last_row, data, offsets in tx.sliced(batch.column("text")):
            lower = tx.LOWER[data]
            starts, ends, first = tx.words(lower, offsets, tx.PLAIN_WORD)
            matches = [
                [{"license": name, "containment": share, "first_word": at} for name, (share, at) in sorted(found.items())]
                for found in scan_words(tx.span_hashes(lower, starts, ends), first, templates)
            ]
            rows = batch.column("doc_id").slice(first_row, last_row - first_row)
            yield pa.RecordBatch.from_arrays([rows, pa.array(matches, kind)], names=["doc_id", "matches"])


def license_matches(documents: DataFrame, templates: Mapping[str, str] | None = None) -> DataFrame:
    """``doc_id, n_licenses, licenses, matches`` for every row of ``documents``.

    ``matches`` has each license with the largest share of its shingles that a window contains
    and the first word of the first such window; ``licenses`` are their names, sorted and
    comma-joined. Without ``templates`` these are ``TEMPLATES`` and ``whole_texts()``.
    """
    if templates is None:
        templates = TEMPLATES | whole_texts()
    prepare_workers(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, matches array<struct<license: string, containment: double, first_word: long>>"
    found = rows.mapInArrow(partial(_scan, templates=Templates(templates)), schema)
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_licenses"), F.concat_ws(",", "matches.license").alias("licenses"), "matches"
    )
