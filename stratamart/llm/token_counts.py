"""Token counts of a BPE tokenizer without its ids (operator 13).

A word's symbols form a linked list. A heap holds the neighbours that have a merge, by rank and
then place; the lowest is popped again and again, and if both symbols are still there, they
become one and their new neighbours go on the heap. The count of a word is the number of its
initial symbols less the number of merges; no ids are looked up or put out.

Texts are read in runs between white space, and a run's count is kept in a bounded table of the
Python worker, as most runs occur again; words are kept in another one. A run is cut at
special strings, which count one each; the rest is normalised by the tokenizer's own rules and
cut into words by its pattern. White space neither joins with neighbours in a normal form nor
belongs to words, so runs can be counted one by one. Texts of any length go through
in parts that end at white space.

Null counts as an empty text, which has no tokens. Rows are counted one by one, whatever their
ids are; nothing is shuffled.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .pieces import LETTER, NUMBER
from .pieces import _kinds as code_point_kinds
from .shared import prepare_workers

PART_CHARS = 1 << 20
TABLE_RUNS = 1 << 19
LONGEST_KEPT = 64

# The characters with the property White_Space, and those that only str.split adds.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = regex.compile(f"[{WHITE_SPACE}]")
_RUN = regex.compile(f"[^{WHITE_SPACE}]+")
_SEPARATORS = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> dict[int, str]:
    """The characters by which byte-level vocabularies write the 256 bytes: printable ones by
    themselves, the others in order from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + at) for at, byte in enumerate(hidden)}


def _ranges(codes: np.ndarray) -> str:
    """Code points as the inside of a character class."""
    cuts = np.flatnonzero(np.diff(codes) != 1) + 1
    return "".join(f"\\U{part[0]:08x}-\\U{part[-1]:08x}" for part in np.split(codes, cuts))


@lru_cache(maxsize=1)
def _letters_and_numbers() -> tuple[regex.Pattern, dict[str, str]]:
    """What ``regex`` takes for a letter or number and the tokenizer library does not, or the
    reverse, and the two classes spelled out as the library knows them."""
    kinds, odd, classes = code_point_kinds(), [], {}
    signs = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for name, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        known = np.flatnonzero(kinds == kind)
        odd.append(np.setxor1d(known, np.array([ord(sign) for sign in regex.findall(name, signs)])))
        classes[name] = _ranges(known)
    return regex.compile(f"[{_ranges(np.unique(np.concatenate(odd)))}]"), classes


class Table(dict):
    """Counts by key, made when missing. It begins anew when full, so memory is bounded."""

    def __init__(self, make, most: int = TABLE_RUNS):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: str) -> int:
        count = self.make(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.clear()
            self[key] = count
        return count


class MergeCounter:
    """Counts tokens as the tokenizer of a ``.json`` file with byte-level BPE words does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.vocabulary = frozenset(model["vocab"])
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.merged = ["".join(pair) for pair in model["merges"]]
        self.suffix = model["end_of_word_suffix"] or ""
        self.symbols = byte_symbols()
        self.normalised = Tokenizer.from_file(path).normalizer.normalize_str
        split, byte_level = described["pre_tokenizer"]["pretokenizers"]
        if byte_level["type"] != "ByteLevel" or byte_level["add_prefix_space"] or byte_level["use_regex"]:
            raise ValueError(f"{path} does not cut texts by one pattern into byte-level words")
        pattern = split["pattern"]["Regex"]
        self.odd, classes = _letters_and_numbers()
        self.pattern = regex.compile(pattern)
        for name, codes in classes.items():
            pattern = pattern.replace(name, codes)
        self.exact_pattern = regex.compile(pattern)
        special = [regex.escape(token["content"]) for token in described["added_tokens"]]
        self.special = regex.compile("|".join(sorted(special, key=len, reverse=True)) or r"(?!)")
        self.words = Table(self.count_word)
        self.runs = Table(self.count_run)

    def count_word(self, word: str) -> int:
        """Initial symbols less merges."""
        parts = [self.symbols[byte] for byte in word.encode()]
        parts[-1] += self.suffix
        # A symbol that the vocabulary lacks is left out, as there is no unknown token.
        parts = [part for part in parts if part in self.vocabulary]
        ranks, merged, last = self.ranks, self.merged, len(parts)
        after, before = list(range(1, last + 1)), list(range(-1, last - 1))
        heap = []
        for at in range(last - 1):
            rank = ranks.get((parts[at], parts[at + 1]))
            if rank is not None:
                heap.append((rank, at))
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, at = heapq.heappop(heap)
            right_at = after[at]
            if parts[at] is None or right_at == last:
                continue
            left, right = parts[at], parts[right_at]
            # A pair that changed since it was pushed makes another symbol, or none. One that makes
            # the same symbol by another merge counts as the one pushed.
            if left + right != merged[rank] or (left, right) not in ranks:
                continue
            parts[at] = left = merged[rank]
            parts[right_at] = None
            after[at] = follower = after[right_at]
            merges += 1
            if follower < last:
                before[follower] = at
                rank = ranks.get((left, parts[follower]))
                if rank is not None:
                    heapq.heappush(heap, (rank, at))
            previous = before[at]
            if previous >= 0:
                rank = ranks.get((parts[previous], left))
                if rank is not None:
                    heapq.heappush(heap, (rank, previous))
        return last - merges

    def count_run(self, run: str) -> int:
        """Tokens of a run without white space."""
        count = 0
        if "<" in run:
            plain = self.special.split(run)
            count = len(plain) - 1
        else:
            plain = [run]
        words = self.words
        for part in plain:
            if part:
                pattern = self.pattern
                if part.isascii():
                    lowered = part.lower()
                else:
                    lowered = self.normalised(part)
                    if self.odd.search(lowered):
                        pattern = self.exact_pattern
                count += sum(map(words.__getitem__, pattern.findall(lowered)))
        return count

    def count(self, text: str) -> int:
        total, start = 0, 0
        while start < len(text):
            end = len(text)
            if end - start > PART_CHARS:
                found = _SPACE.search(text, start + PART_CHARS)
                end = found.start() if found else end
            part = text[start:end]
            runs = _RUN.findall(part) if _SEPARATORS.search(part) else part.split()
            total += sum(map(self.runs.__getitem__, runs))
            start = end
        return total


@lru_cache(maxsize=2)
def _counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counter = _counter(path)
    for batch in batches:
        texts = batch.column("text")
        counts = [counter.count(text.as_py() or "") for text in texts]
        sizes = pc.fill_null(pc.binary_length(texts.cast(pa.large_binary())), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), sizes, pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
        )


def token_counts(documents: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``documents``."""
    prepare_workers(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = rows.mapInArrow(partial(_count, path=path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
