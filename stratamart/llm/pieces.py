"""Texts cut into the pieces that byte-level tokenizers encode one by one.

The pattern of these tokenizers takes contractions, then runs of letters, of numbers and of
other signs, each with a blank before it if there is one, then white space, of which the last
character is left to the piece after it. A regular expression engine walks through a text sign
by sign; here the same cuts are found for a slice of texts at once, from the kinds of
neighbouring code points. Any other pattern goes through the ``regex`` library.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex

from .texts import ranges, token_run_hashes

#: The pattern whose cuts ``piece_starts`` finds.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Where Unicode 16, which the tokenizer libraries know, has letters and numbers that
# the tables of Python may lack.
LATER_RANGES = [
    (0x1C89, 0x1C8A),
    (0xA7CB, 0xA7CD),
    (0xA7DA, 0xA7DC),
    (0x105C0, 0x105F3),
    (0x10D40, 0x10EC4),
    (0x11380, 0x116E3),
    (0x11BC0, 0x11BF9),
    (0x13460, 0x16D79),
    (0x18CFF, 0x18CFF),
    (0x1CCF0, 0x1CCF9),
    (0x1E5D0, 0x1E5FA),
]

SPACE, LETTER, NUMBER, OTHER = range(4)
BLANK, QUOTE = 0x20, 0x27
KEPT_PIECES = 600_000


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of every code point, by the Unicode tables of Python and of ``regex``."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(code))[0], OTHER) for code in range(sys.maxunicode + 1)], np.uint8)
    later = "".join(chr(code) for a, b in LATER_RANGES for code in range(a, b + 1) if unicodedata.category(chr(code)) == "Cn")
    for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        table[[ord(sign) for sign in regex.findall(name, later)]] = kind
    spaces = regex.findall(r"\p{White_Space}", "".join(map(chr, range(0x3001))))
    table[[ord(sign) for sign in spaces]] = SPACE
    return table


def _begins(codes: np.ndarray, at: np.ndarray, word: str) -> np.ndarray:
    """Where the signs after some places are those of a word; the codes have places to spare."""
    out = np.ones(len(at), bool)
    for step, sign in enumerate(word, 1):
        out &= codes[at + step] == ord(sign)
    return out


def piece_starts(codes: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts that follow each other; ``text_starts`` has no empty text."""
    count = len(codes)
    codes = np.concatenate((codes, np.zeros(4, codes.dtype)))
    kind = _kinds()[codes[:count]]
    first = np.zeros(count + 1, bool)  # the first code point of a text, or the end of all
    first[text_starts] = True
    first[count] = True
    run = first[:count].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    space = kind == SPACE
    followed = np.zeros(count, bool)  # white space with other signs behind it
    followed[:-1] = space[:-1] & ~space[1:] & ~first[1:count]
    start |= followed
    # A blank belongs to the run behind it.
    after_blank = np.flatnonzero(followed & (codes[:count] == BLANK)) + 1
    start[after_blank] = False
    # Contractions: a quote that begins a piece, with letters right behind it.
    quotes = np.flatnonzero(start & (codes[:count] == QUOTE) & run)
    quotes = quotes[(quotes + 1 < count)]
    quotes = quotes[(kind[quotes + 1] == LETTER) & ~first[quotes + 1]]
    for ending in ("s", "t", "re", "ve", "m", "ll", "d"):
        here = quotes[_begins(codes, quotes, ending)]
        end = here + 1 + len(ending)
        whole = ~np.any([first[np.minimum(here + step, count)] for step in range(1, len(ending) + 1)], axis=0)
        here, end = here[whole], end[whole]
        start[here + 1] = False
        start[end[end < count]] = True
    return np.flatnonzero(start)


class TextEncoder:
    """Encodes texts slice by slice, each distinct piece once, with a bounded table of pieces.

    ``encode_pieces`` gives the ids of some pieces, one after another, and how many each has.
    Pieces are told apart by 64-bit hashes of their code points.
    """

    def __init__(self, pattern: str, encode_pieces: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.pattern = None if pattern == PATTERN else regex.compile(pattern)
        self.encode_pieces = encode_pieces
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # by hash
        self.ids, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _pieces(self, codes: np.ndarray, texts: list[str], sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes)
        if self.pattern is None:
            return piece_starts(codes, (ends - sizes)[sizes > 0])
        found = [match.start() + before for text, before in zip(texts, (ends - sizes).tolist(), strict=True) for match in self.pattern.finditer(text)]
        return np.array(found, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and how many ids come before each text and in all."""
        sizes = np.array([len(text) for text in texts], np.int64)
        if not sizes.sum():
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        starts = self._pieces(codes, texts, sizes)
        ends = np.append(starts[1:], len(codes))
        hashes = token_run_hashes(codes.astype(np.uint64), starts, ends)
        order = np.argsort(hashes)
        fresh = np.flatnonzero(np.concatenate(([True], hashes[order[1:]] != hashes[order[:-1]])))
        distinct = order[fresh]
        which = np.empty(len(order), np.int64)
        which[order] = np.repeat(np.arange(len(fresh)), np.diff(np.append(fresh, len(order))))

        if len(self.hashes) > KEPT_PIECES:
            self._forget()
        wanted = hashes[distinct]
        places = np.searchsorted(self.hashes, wanted)
        known = np.append(self.hashes, np.uint64(0))[places] == wanted
        known &= places < len(self.hashes)
        number_of = np.append(self.numbers, -1)[places]
        new = np.flatnonzero(~known)
        if len(new):
            cuts = zip(starts[distinct[new]].tolist(), ends[distinct[new]].tolist(), strict=True)
            ids, counts = self.encode_pieces([whole[a:b] for a, b in cuts])
            number_of[new] = np.arange(len(self.hashes), len(self.hashes) + len(new))
            self.numbers = np.insert(self.numbers, places[new], number_of[new])
            self.hashes = np.insert(self.hashes, places[new], wanted[new])
            self.ids, self.counts = np.concatenate((self.ids, ids)), np.concatenate((self.counts, counts))

        own_counts = self.counts[number_of]
        own_starts = (np.cumsum(self.counts) - self.counts)[number_of]
        counts = own_counts[which]
        before = np.concatenate(([0], np.cumsum(counts)))
        first_piece = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
        return self.ids[ranges(own_starts[which], counts)], before[first_piece]

