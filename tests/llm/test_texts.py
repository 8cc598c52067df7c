from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from cases import odd_documents, plain_words, spaced

from stratamart.llm import texts as tx

TEXTS = [text for _, text in odd_documents()]


def test_words_of_every_text_in_slices_of_any_size():
    for most in (1, 1000, 1 << 21):
        for inside, cut, lower in ((tx.NOT_SPACE, spaced, False), (tx.PLAIN_WORD, lambda t: [w.encode() for w in plain_words(t)], True)):
            found = []
            for first_row, last_row, data, offsets in tx.sliced(pa.array(TEXTS), most):
                data = tx.LOWER[data] if lower else data
                starts, ends, first = tx.words(data, offsets, inside)
                raw = data.tobytes()
                for row in range(last_row - first_row):
                    found.append([raw[starts[i] : ends[i]] for i in range(first[row], first[row + 1])])
            assert found == [cut(text) for text in TEXTS]


def test_equal_words_and_runs_have_equal_hashes_wherever_they_are():
    pick = random.Random(1)
    words = [f"w{pick.randrange(50)}" for _ in range(4000)]
    hashes = []
    for text in (" ".join(words), "\t\n ".join(words) + " "):
        data, offsets = tx.utf8(pa.array(["before", text]))
        starts, ends, first = tx.words(data, offsets, tx.NOT_SPACE)
        hashes.append(tx.span_hashes(data, starts, ends)[first[1] :])
    assert (hashes[0] == hashes[1]).all()
    assert len(set(hashes[0].tolist())) == len(set(words))
    for of in (lambda h: tx.run_hashes(h, 3), lambda h: tx.run_values(h, 3)):
        runs = of(hashes[0])
        tuples = list(zip(words, words[1:], words[2:], strict=False))
        assert len({*zip(runs.tolist(), tuples, strict=True)}) == len(set(tuples)) == len(set(runs.tolist()))


def test_sliding_argmin():
    pick = np.random.default_rng(2)
    values = pick.integers(0, 6, 500).astype(np.uint64) << np.uint64(50)
    for width in (1, 2, 3, 5, 8, 13, 500):
        found = tx.sliding_argmin(values, width)
        assert found.tolist() == [at + int(np.argmin(values[at : at + width])) for at in range(500 - width + 1)]
    assert len(tx.sliding_argmin(values, 501)) == 0


def test_a_sliced_column_keeps_its_own_rows():
    column = pa.array(["aa", None, "b", "", "ccc"])
    data, offsets = tx.utf8(column.slice(1, 3))
    assert data.tobytes() == b"b" and offsets.tolist() == [0, 0, 1, 1]
