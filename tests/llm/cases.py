"""Documents with everything that can be odd, and plain versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re

# Names that operators use inside; documents may have columns with the same names.
CLASHING = ["text_key", "digest", "node", "band", "spans", "score", "kept", "bucket", "a", "places", "size", "kind"]
SPACES = " \t\n\v\f\r"


def frame(spark, rows, clashing=True):
    names = CLASHING if clashing else []
    schema = "doc_id long, text string" + "".join(f", {name} string" for name in names)
    return spark.createDataFrame([(*row, *(["x"] * len(names))) for row in rows], schema)


def prose(number, length, vocabulary=40):
    pick = random.Random(number)
    return " ".join(f"w{pick.randrange(vocabulary)}é" if pick.random() < 0.1 else f"w{pick.randrange(vocabulary)}" for _ in range(length))


def odd_documents():
    """Ids repeat only with the same text, except for id 50; one row has no id."""
    passage, base = prose(1, 90, 500), prose(2, 200, 500)
    words = base.split()
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "Word"),
        (5, "two words"),
        (6, "two  words"),
        (7, "TWO words"),
        (8, f"{passage} {prose(3, 40)}"),
        (9, f"{prose(4, 60)} {passage} {prose(5, 30)}"),
        (10, passage),
        (11, passage),
        (12, f"{passage}\n{passage}"),
        (13, base),
        (14, " ".join(words[:100] + ["other"] + words[101:])),
        (15, " ".join(words[:190])),
        (16, " ".join(words[:20] + words[60:])),
        (17, base.upper()),
        (18, base.replace(" ", " ")),
        (19, "日本語のテキスト 🙂 " * 30),
        (20, "日本語のテキスト 🙂 " * 30 + "!"),
        (21, "ab" * 40_000),
        (22, "x" + "ab" * 40_000),
        (23, prose(6, 30_000, 5_000)),
        (24, base),
        (24, base),
        (50, "one text"),
        (50, prose(7, 80, 500)),
        (None, base),
        (None, None),
    ]
    # Many copies of one text, over several rows of a batch.
    return rows + [(100 + at, base) for at in range(30)]


def spaced(text):
    return (text or "").encode().split()


def lower(text):
    return (text or "").encode().lower().decode()


def shingles(text, length):
    words = lower(text).encode().split()
    if len(words) >= length:
        return {tuple(words[at : at + length]) for at in range(len(words) - length + 1)}
    return {tuple(words)} if words else set()


def near_components(rows, length):
    """Smallest reachable id of each id, by comparing all pairs."""
    sets = [(doc_id, shingles(text, length)) for doc_id, text in rows if doc_id is not None]
    label = {doc_id: doc_id for doc_id, _ in sets}

    def find(node):
        while label[node] != node:
            node = label[node]
        return node

    for i, (a, left) in enumerate(sets):
        for b, right in sets[:i]:
            both = len(left & right)
            if left and right and 100 * both >= 80 * (len(left) + len(right) - both):
                low, high = sorted((find(a), find(b)))
                label[high] = low
    return {doc_id: find(doc_id) for doc_id in label}


def without_repeats(rows, tokens, window=50):
    """Tokens, kept tokens and number of removed runs of each row."""
    first = {}
    for doc_id, text in rows:
        if doc_id is not None:
            own = tokens(text)
            for at in range(len(own) - window + 1):
                key = tuple(own[at : at + window])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        own = tokens(text)
        stays = [True] * len(own)
        for at in range(len(own) - window + 1):
            if doc_id is not None and first[tuple(own[at : at + window])] < doc_id:
                stays[at : at + window] = [False] * window
        runs = sum(not now and (at == 0 or stays[at - 1]) for at, now in enumerate(stays))
        out.append((doc_id, own, [token for token, kept in zip(own, stays, strict=True) if kept], runs))
    return out


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def sha(data):
    return hashlib.sha256(data).hexdigest()


def by_repr(rows):
    return sorted(rows, key=repr)
