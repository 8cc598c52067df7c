"""Quality scores by a generalised additive model with pairwise interactions (operator 3).

Every text gives some thirty numbers: shares of kinds of bytes, sizes of words and lines, how
much is repeated. The model is a sum of one lookup table per number, over bins, and of tables
over pairs of numbers. Boosting goes round the numbers; each turn fits a tree with a few leaves
to the present errors of one number's bins and adds a small part of it to that table. The pairs
that explain most of what is left then get their turns with trees of four leaves. A score is a
vectorised addition of table entries, passed through the logistic function.

The model is fitted on the driver on at most ``SAMPLE_ROWS`` labelled rows, those with the
smallest hash of their id. The texts are read once: their numbers are written to the shared
folder, and both the sample and the scores are taken from there.

Null and empty texts have the numbers of a text without bytes and get a score like any other.
A label that repeats counts by its mean; rows of labels without document or label are ignored.
Without any label every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx
from .shared import hashed_sample, prepare_workers, stored, with_text_key

SAMPLE_ROWS = 12_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE = 0.15
LEAVES = 3
SMOOTHING = 5.0
ACCEPT_AT = 0.7


def _bytes_in(wanted: bytes) -> np.ndarray:
    return np.array([byte in wanted for byte in range(256)], float)


UPPER = _bytes_in(bytes(range(65, 91)))
SMALL = _bytes_in(bytes(range(97, 123)))
SYMBOLS = _bytes_in(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
BYTE_KINDS = np.stack(
    [
        UPPER,
        SMALL,
        _bytes_in(bytes(range(48, 58))),
        _bytes_in(bytes(range(128, 256))),
        SYMBOLS,
        _bytes_in(b"."),
        _bytes_in(b","),
        _bytes_in(b"!?"),
        _bytes_in(b"|<>{}[]\\/"),
        _bytes_in(b"*#$%&@~^_=+"),
        _bytes_in(b"\"'()-:;"),
        _bytes_in(b" "),
        _bytes_in(b"\n"),
        _bytes_in(bytes(b for b in range(32) if b != 10)),
    ],
    axis=1,
)


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    sums = np.concatenate(([0.0], np.cumsum(values, dtype=float)))
    return sums[first[1:]] - sums[first[:-1]]


def _different(hashes: np.ndarray, first: np.ndarray, length: int = 1) -> np.ndarray:
    """The share of different runs among the runs of ``length`` hashes of each text."""
    runs = tx.run_hashes(hashes, length) if length > 1 else hashes
    out = np.ones(len(first) - 1)
    for row, (a, b) in enumerate(zip(first[:-1], first[1:] - length + 1, strict=True)):
        if b > a + 1:
            found = np.sort(runs[a:b])
            out[row] = (1 + np.count_nonzero(found[1:] != found[:-1])) / (b - a)
    return out


def numbers(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers for each text of a slice."""
    rows = len(offsets) - 1
    counts = np.stack([np.bincount(data[a:b], minlength=256) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
    size = np.maximum(counts.sum(axis=1), 1)[:, None]
    shares = counts / size
    kinds = shares @ BYTE_KINDS
    entropy = -(shares * np.log2(np.where(shares > 0, shares, 1))).sum(axis=1)
    upper = counts @ UPPER
    letters = np.maximum(upper + counts @ SMALL, 1)

    starts, ends, first = tx.words(data, offsets, tx.NOT_SPACE)
    hashes = tx.span_hashes(data, starts, ends)
    n_words = np.diff(first)
    some = np.maximum(n_words, 1)
    sizes = (ends - starts).astype(float)
    mean = _per_text(sizes, first) / some
    spread = np.sqrt(np.maximum(_per_text(sizes**2, first) / some - mean**2, 0))
    symbol = SYMBOLS.astype(bool)
    last, inner = data[ends - 1], data[np.maximum(ends - 2, starts)]
    ends_in_symbols = symbol[last] & symbol[inner] & (sizes > 1)
    only_symbols = symbol[last] & symbol[data[starts]]
    capital = UPPER.astype(bool)[data[starts]]
    line_starts, line_ends, first_line = tx.words(data, offsets, _NOT_LINE_END)
    lines = np.diff(first_line)
    line_sizes = (line_ends - line_starts).astype(float)
    line_mean = _per_text(line_sizes, first_line) / np.maximum(lines, 1)
    line_spread = np.sqrt(np.maximum(_per_text(line_sizes**2, first_line) / np.maximum(lines, 1) - line_mean**2, 0))

    columns = [
        np.log1p(counts.sum(axis=1)),
        entropy,
        upper / letters,
        np.log1p(n_words),
        mean,
        spread,
        _per_text(sizes <= 3, first) / some,
        _per_text(sizes >= 12, first) / some,
        _per_text(ends_in_symbols, first) / some,
        _per_text(only_symbols, first) / some,
        _per_text(capital, first) / some,
        _different(hashes, first),
        _different(hashes, first, 3),
        np.log1p(lines),
        line_mean,
        line_spread,
        _different(tx.span_hashes(data, line_starts, line_ends), first_line),
    ]
    return np.concatenate([kinds, np.stack(columns, axis=1)], axis=1).reshape(rows, -1)


_NOT_LINE_END = np.array([byte != 10 for byte in range(256)])


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in tx.sliced(batch.column("text")):
            found = numbers(data, offsets)
            at = np.arange(0, found.size + 1, found.shape[1])
            values = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(found.reshape(-1)))
            keys = [batch.column(name).slice(first, last - first) for name in ("doc_id", "text_key")]
            yield pa.RecordBatch.from_arrays([*keys, values], names=["doc_id", "text_key", "numbers"])


@dataclass
class AdditiveModel:
    """Edges of bins, a table per number, and a table per chosen pair of numbers."""

    base: float
    edges: list[np.ndarray]
    tables: np.ndarray
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray

    def score(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.base)
        for at, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, values[:, at], "right")]
        coarse = {at: np.searchsorted(self.pair_edges[at], values[:, at], "right") for pair in self.pairs for at in pair}
        for (one, two), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[one], coarse[two]]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Values of the bins after the best ``LEAVES - 1`` cuts of one row of bins."""
    cuts = [0, len(gradient)]
    g, w = np.concatenate(([0], np.cumsum(gradient))), np.concatenate(([0], np.cumsum(weight)))

    def gain(a, b):
        return (g[b] - g[a]) ** 2 / (w[b] - w[a] + SMOOTHING)

    for _ in range(LEAVES - 1):
        best, where = 1e-9, None
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            inside = np.arange(a + 1, b)
            if len(inside):
                gains = gain(a, inside) + gain(inside, b) - gain(a, b)
                if gains.max() > best:
                    best, where = gains.max(), inside[gains.argmax()]
        if where is None:
            break
        cuts = sorted([*cuts, where])
    out = np.zeros(len(gradient))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = (g[b] - g[a]) / (w[b] - w[a] + SMOOTHING)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cross-shaped cut of a table of bins."""
    size = len(gradient)
    g = np.zeros((size + 1, size + 1))
    w = np.zeros((size + 1, size + 1))
    g[1:, 1:], w[1:, 1:] = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)

    def parts(table):
        a = table[1:-1, 1:-1]
        b, c = table[1:-1, -1:] - a, table[-1:, 1:-1] - a
        return np.stack([a, b, c, table[-1, -1] - a - b - c])

    values = parts(g) / (parts(w) + SMOOTHING)
    gains = (values * parts(g)).sum(axis=0)
    row, column = np.unravel_index(gains.argmax(), gains.shape)
    out = np.empty_like(gradient)
    a, b, c, d = values[:, row, column]
    out[: row + 1, : column + 1], out[: row + 1, column + 1 :] = a, b
    out[row + 1 :, : column + 1], out[row + 1 :, column + 1 :] = c, d
    return float(gains.max()), out


def fit(values: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """The model of some labelled rows; it depends on nothing but them."""
    count = values.shape[1] if values.ndim == 2 else 0
    if not len(labels):
        return AdditiveModel(0.0, [], np.zeros((0, BINS)), [], [], np.zeros((0, PAIR_BINS, PAIR_BINS)))
    rate = (labels.sum() + 1) / (len(labels) + 2)
    base = float(np.log(rate / (1 - rate)))
    edges = [_edges(values[:, at], BINS) for at in range(count)]
    bins = [np.searchsorted(edges[at], values[:, at], "right") for at in range(count)]
    tables = np.zeros((count, BINS))
    total = np.full(len(labels), base)

    def errors():
        chance = 1 / (1 + np.exp(-total))
        return labels - chance, chance * (1 - chance)

    for _ in range(ROUNDS):
        for at in range(count):
            error, weight = errors()
            step = RATE * _tree(np.bincount(bins[at], error, BINS), np.bincount(bins[at], weight, BINS))
            tables[at] += step
            total += step[bins[at]]

    pair_edges = [_edges(values[:, at], PAIR_BINS) for at in range(count)]
    coarse = [np.searchsorted(pair_edges[at], values[:, at], "right") for at in range(count)]

    def turn(one: int, two: int):
        error, weight = errors()
        cell, size = coarse[one] * PAIR_BINS + coarse[two], PAIR_BINS**2
        shape = (PAIR_BINS, PAIR_BINS)
        return cell, _quadrants(np.bincount(cell, error, size).reshape(shape), np.bincount(cell, weight, size).reshape(shape))

    gains = {(one, two): turn(one, two)[1][0] for one in range(count) for two in range(one)}
    pairs = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    pair_tables = np.zeros((len(pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_ROUNDS):
        for at, pair in enumerate(pairs):
            cell, (_, step) = turn(*pair)
            pair_tables[at] += RATE * step
            total += RATE * step.reshape(-1)[cell]
    return AdditiveModel(base, edges, tables, pair_edges, pairs, pair_tables)


def apply_model(batches: Iterator[pa.RecordBatch], model: AdditiveModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("numbers")
        values = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))
        scores = pa.array(model.score(values), pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), scores], names=["doc_id", "text_key", "score"])


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_scores(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted, text_key`` for every row of ``documents``.

    Labels of held-out ids are never learnt.
    """
    prepare_workers(documents.sparkSession)
    rows = with_text_key(documents)
    described = stored(rows.mapInArrow(describe, "doc_id long, text_key long, numbers array<double>"), "quality_numbers")
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    known = known.where(~held_out()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    known = stored(known, "quality_labels")
    columns = ["label", "numbers"]
    found = hashed_sample(described.join(known, "doc_id"), sample_rows, known.count(), ["numbers"], lambda sample: sample.select(columns))
    values = np.array([row["numbers"] for row in found], float) if found else np.zeros((0, 0))
    model = fit(values, np.array([row["label"] for row in found], float))
    scored = described.mapInArrow(partial(apply_model, model=model), "doc_id long, text_key long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT_AT).cast("int").alias("predicted"), "text_key")
