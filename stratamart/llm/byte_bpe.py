"""Byte-level BPE encoding and decoding in numpy matrices (operator 2).

A text is cut into pieces by the tokenizer's pattern. A piece that is a token is that token; any
other starts as its bytes and merges, again and again, the leftmost of the neighbours with the
smallest rank. Pieces of similar length fill one padded matrix in which every row merges once
a round: ranks of neighbours come from a hash table with vectorised probing, the rest of a row
moves up by one place, and finished rows leave the matrix. Pieces over ``LONGEST_ROW`` bytes
follow the same rule with a heap, whose work does not grow with the square of the length.

A slice of texts encodes each distinct piece once; a bounded table of pieces is carried from
slice to slice (``pieces``). Null counts as an empty text, which has no ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import TextEncoder
from .shared import prepare_workers
from .texts import numbered, ranges, sliced

NO_RANK = np.int32(2**31 - 1)
WIDTHS = (2, 4, 8, 16, 32, 64, 128, 256)
LONGEST_ROW = WIDTHS[-1]


class PairTable:
    """Ranks of neighbouring ids by open addressing with linear probing."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.factor = numbered(77, 1)[0] | np.uint64(1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int32)
        self.probes, waiting = 0, np.arange(len(keys))
        while len(waiting):
            slots = self._slots(keys[waiting], self.probes)
            free = np.flatnonzero(self.keys[slots] == -1)
            _, chosen = np.unique(slots[free], return_index=True)
            placed = free[chosen]
            self.keys[slots[placed]] = keys[waiting[placed]]
            self.ranks[slots[placed]] = ranks[waiting[placed]]
            waiting = np.delete(waiting, placed)
            self.probes += 1

    def _slots(self, keys: np.ndarray, probe: int) -> np.ndarray:
        home = (keys.astype(np.uint64) * self.factor) >> self.shift
        return (home.astype(np.int64) + probe) & self.mask

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; -1 stands for no id and has no pairs."""
        out = np.full(left.shape, NO_RANK, np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left.reshape(-1)[at].astype(np.int64) << 32) | right.reshape(-1)[at]
        flat = out.reshape(-1)
        for probe in range(self.probes):
            slots = self._slots(keys, probe)
            found = self.keys[slots]
            hit = found == keys
            flat[at[hit]] = self.ranks[slots[hit]]
            on = ~hit & (found != -1)
            at, keys = at[on], keys[on]
            if not len(at):
                break
        return out


class ByteBpe:
    """A tokenizer of a rank file, whose ids are the ranks."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.byte_ids = np.array([self.ranks[bytes([byte])] for byte in range(256)], np.int32)
        self.pairs = {
            (self.ranks[token[:cut]], self.ranks[token[cut:]]): rank
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        }
        left, right = np.array(list(self.pairs), np.int64).reshape(-1, 2).T
        self.table = PairTable((left << 32) | right, np.array(list(self.pairs.values()), np.int32))
        size = max(self.ranks.values()) + 1
        by_id = [b""] * size
        for token, rank in self.ranks.items():
            by_id[rank] = token
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.token_sizes = np.array([len(token) for token in by_id], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes

    def encode_pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, piece after piece, and the number of ids of each piece."""
        pieces = [text.encode() for text in texts]
        counts = np.ones(len(pieces), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # piece numbers of ids, ids
        known = np.array([self.ranks.get(piece, -1) for piece in pieces], np.int32)
        whole = np.flatnonzero(known >= 0)
        found.append((whole, known[whole]))
        sizes = np.array([len(piece) for piece in pieces], np.int64)
        below = 1
        for width in WIDTHS:
            picked = np.flatnonzero((known < 0) & (sizes > below) & (sizes <= width))
            below = width
            if len(picked):
                found += self._merge_rows([pieces[i] for i in picked], picked, width, counts)
        for i in np.flatnonzero((known < 0) & (sizes > LONGEST_ROW)):
            ids = np.array(self._merge_long(pieces[i]), np.int32)
            counts[i] = len(ids)
            found.append((np.full(len(ids), i), ids))
        order = np.argsort(np.concatenate([owner for owner, _ in found]), kind="stable")
        return np.concatenate([ids for _, ids in found])[order], counts

    def _merge_rows(self, pieces: list[bytes], owners: np.ndarray, width: int, counts: np.ndarray):
        sizes = np.array([len(piece) for piece in pieces])
        ids = np.full((len(pieces), width + 1), -1, np.int32)  # the last column stays empty
        ids[np.repeat(np.arange(len(pieces)), sizes), ranges(np.zeros(len(pieces), np.int64), sizes)] = self.byte_ids[
            np.frombuffer(b"".join(pieces), np.uint8)
        ]
        ranks = self.table.look_up(ids[:, :-1], ids[:, 1:])
        columns = np.arange(width)
        while len(ids):
            best = ranks.argmin(axis=1)
            rows = np.arange(len(ids))
            rank = ranks[rows, best]
            done = rank == NO_RANK
            if done.any():
                left = ids[done]
                used = left >= 0
                number = used.sum(axis=1)
                counts[owners[done]] = number
                yield np.repeat(owners[done], number), left[used]
                on = ~done
                ids, ranks, owners, best, rank = ids[on], ranks[on], owners[on], best[on], rank[on]
                rows = np.arange(len(ids))
                if not len(ids):
                    return
            # What stands behind the merged pair moves up by one place.
            behind = columns + (columns > best[:, None])
            ids[:, :-1] = np.take_along_axis(ids, behind, axis=1)
            ids[rows, best] = rank
            ranks[:, :-1] = np.take_along_axis(ranks, np.minimum(behind, width - 1), axis=1)[:, :-1]
            ranks[:, -1] = NO_RANK
            ranks[rows, best] = self.table.look_up(ids[rows, best], ids[rows, best + 1])
            before = np.flatnonzero(best > 0)
            ranks[before, best[before] - 1] = self.table.look_up(ids[before, best[before] - 1], ids[before, best[before]])

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        alive = [True] * len(ids)
        heap = [(rank, at, at + 1) for at in range(len(ids) - 1) if (rank := self.pairs.get((ids[at], ids[at + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at, other = heapq.heappop(heap)
            if not (alive[at] and other < len(ids) and after[at] == other and self.pairs.get((ids[at], ids[other])) == rank):
                continue
            ids[at], alive[other], after[at] = rank, False, after[other]
            if after[at] < len(ids):
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < len(ids):
                    following = self.pairs.get((ids[left], ids[after[left]]))
                    if following is not None:
                        heapq.heappush(heap, (following, left, after[left]))
        return [token for token, lives in zip(ids, alive, strict=True) if lives]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of the ids, and how many bytes come before each id and after the last."""
        sizes = self.token_sizes[ids]
        return self.token_bytes[ranges(self.token_starts[ids], sizes)], np.concatenate(([0], np.cumsum(sizes)))


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> TextEncoder:
    """One encoder for all tasks of a worker, so that its table of pieces is used again."""
    return TextEncoder(pattern, tokenizer(path).encode_pieces)


def encode_texts(batches: Iterator[pa.RecordBatch], path: str, pattern: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    bpe = tokenizer(path)
    for batch in batches:
        column = batch.column("text")
        for first, last, _, _ in sliced(column):
            texts = [text or "" for text in column.slice(first, last - first).to_pylist()]
            ids, at = encoder(path, pattern).encode(texts)
            raw, byte_at = bpe.decode(ids)
            encoded = memoryview(ids.astype("<u4").tobytes())
            decoded = memoryview(raw.tobytes())
            cuts = byte_at[at]
            columns = [
                batch.column("doc_id").slice(first, last - first),
                pa.array(np.diff(at), pa.int64()),
                pa.array([hashlib.sha256(encoded[4 * a : 4 * b]).hexdigest() for a, b in zip(at, at[1:], strict=False)], pa.string()),
                pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:], strict=False)], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def encode_documents(documents: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if wanted, ``ids`` for every row.

    ``path`` names a rank file that every executor has, ``pattern`` how it splits texts. The
    decoded digest is taken from the bytes that the ids decode to.
    """
    prepare_workers(documents.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    rows = documents.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
    return rows.mapInArrow(partial(encode_texts, path=path, pattern=pattern, with_ids=with_ids), schema)
