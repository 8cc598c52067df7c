from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from cases import by_repr, lower, odd_documents

from stratamart.llm import collocations as co

SCHEMA = "doc_id long, lang string, text string, phrase string, a string, rank string, block string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(at, lang, text, *"xxxxx") for at, (lang, text) in enumerate(rows)], SCHEMA)


def pieces(text):
    return [re.findall(r"[^ \t]+", part) for part in re.split(r"[.,;:!?\n-\r]", lower(text))]


def plain(rows, least=10, most=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for words in pieces(text):
            n[lang or "und"] += len(words)
            for size in (1, 2, 3):
                f.update((lang or "und", tuple(words[at : at + size])) for at in range(len(words) - size + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, words), a in candidates.items():
        for part in (words[:2], words[1:]) if len(words) == 3 else ():
            longer[lang, part] = max(longer[lang, part], a)
    out = {}
    for (lang, words), a in candidates.items():
        if (lang, words) in longer and 100 * longer[lang, words] >= 50 * a:
            continue
        cuts = [(words[:k], words[k:]) for k in range(1, len(words))]
        score, k = min((1000000 * a * a // (f[lang, left] * f[lang, right]), k) for k, (left, right) in enumerate(cuts))
        left, right = cuts[k]
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, left], f[lang, right]))
    return [
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1)
    ]


def some_rows():
    pick = random.Random(5)
    words = ["New", "york", "the", "of", "ÄÖ", "a", "a", "日本", "x\xa0y", "\x00"]
    rows = [(None if at % 3 else "en", " ".join(pick.choice(words) + pick.choice(["", "", ".", ",\t", "!"]) for _ in range(60))) for at in range(80)]
    rows += [("de" if at % 2 else "und", text) for at, (_, text) in enumerate(odd_documents())]
    return rows + [("fr", "le même texte, toujours le même texte"), ("fr", None), ("fr", "")] * 30


def test_odd_documents(spark):
    rows = some_rows()
    found = [tuple(row) for row in co.collocations(frame(spark, rows)).collect()]
    assert found and by_repr(found) == by_repr(plain(rows))


def test_first_of_each_language_and_other_bounds(spark):
    rows = some_rows()
    found = [tuple(row) for row in co.collocations(frame(spark, rows), least=3, most=7).collect()]
    assert by_repr(found) == by_repr(plain(rows, least=3, most=7))
    assert max(row[1] for row in found) == 7


def test_one_word_over_and_over(spark):
    rows = [("en", "go " * 5000), ("en", "go")]
    assert by_repr(tuple(row) for row in co.collocations(frame(spark, rows)).collect()) == by_repr(plain(rows))


def test_small_blocks_and_ranges_give_the_same(spark, monkeypatch):
    """Blocks and ranges are made on the driver's settings in local workers only by their size."""
    rows = some_rows()
    monkeypatch.setattr(co, "RANGE_PHRASES", 50)
    found = [tuple(row) for row in co.collocations(frame(spark, rows)).collect()]
    assert by_repr(found) == by_repr(plain(rows))


def test_counts_beyond_64_bits(spark):
    phrases = spark.createDataFrame(
        [("en", 1, "x", 10**15), ("en", 1, "y", 10**15 - 1), ("en", 2, "x y", 10**15 - 2)], "lang string, length int, phrase string, a long"
    )
    found = co.scored(phrases).first()
    assert found.score == 1000000 * (10**15 - 2) ** 2 // (10**15 * (10**15 - 1))


def test_chunks_cover_each_piece_once():
    pick = np.random.default_rng(3)
    words = pick.integers(0, 2**63, 5000).astype(np.uint64)
    piece = np.sort(pick.integers(0, 300, 5000))
    firsts, lasts, ends_piece = co.chunk_spans(words, piece)
    owned = np.where(ends_piece, lasts, lasts - 2)
    assert firsts[0] == 0 and owned[-1] == 5000 and (owned[:-1] == firsts[1:]).all()
    assert all(len(set(piece[a:b])) == 1 for a, b in zip(firsts, lasts, strict=True))
    assert (~ends_piece).sum() > 300


def test_empty_table(spark):
    assert co.collocations(frame(spark, [])).collect() == []
    assert co.collocations(frame(spark, [("en", None), (None, " . ")])).collect() == []
