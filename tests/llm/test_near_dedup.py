from __future__ import annotations

import numpy as np
import pytest
from cases import frame, near_components, odd_documents, prose, shingles

from stratamart.llm import near_dedup
from stratamart.llm.graph import components


def check(spark, rows, length):
    found = near_dedup.near_duplicates(frame(spark, rows), length).collect()
    wanted = near_components(rows, length)
    assert len(found) == len(rows)
    assert sorted((r.doc_id, r.n_shingles) for r in found if r.doc_id is not None) == sorted(
        (i, len(shingles(text, length))) for i, text in rows if i is not None
    )
    for row in found:
        assert row.component_id == wanted.get(row.doc_id)
        assert row.kept == (row.doc_id is None or row.doc_id == row.component_id)


@pytest.mark.parametrize("length", [4, 5])
def test_odd_documents(spark, length):
    check(spark, odd_documents(), length)


def test_chains_and_groups_of_loose_copies(spark):
    rows = []
    for group in range(6):
        words = prose(group, 120, 2000).split()
        for copy in range(25):
            pick = np.random.default_rng(100 * group + copy)
            changed = [w if pick.random() > 0.012 * (copy % 5) else f"n{pick.integers(10**6)}" for w in words]
            rows.append((1000 * group + copy, " ".join(changed)))
    words = prose(99, 100, 2000).split()
    rows += [(9000 + step, " ".join(words[3 * step :] + prose(step, 3 * step, 2000).split())) for step in range(8)]
    check(spark, rows, 4)


def of_template(count, own=60):
    """Documents that share 200 words and have 60 of their own, so that no two of them are linked."""
    base = prose(7, 200, 3000)
    return [(at, f"{base} " + " ".join(f"x{at}y{word}" for word in range(own))) for at in range(count)]


def test_documents_of_one_template_do_not_meet(spark, monkeypatch):
    """What is compared does not grow with the square of the group."""
    compared = []
    estimated = near_dedup._estimated
    monkeypatch.setattr(near_dedup, "_estimated", lambda pairs, signed: compared.append(pairs.count()) or estimated(pairs, signed))
    # Two of them differ in their last words only, in different places of the ids.
    rows = of_template(4000)
    rows += [(10_000, rows[1700][1] + " more"), (10_001, rows[30][1].replace("x30y5 ", "other "))]
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows), 4).collect()}
    assert found == {**{at: at for at in range(4000)}, 10_000: 1700, 10_001: 30}
    # One pair per class and band with the smallest class at most, and hardly any after that.
    assert len(compared) <= 2 and compared[0] <= 24 * 4002 and sum(compared[1:]) < 4002


def test_groups_that_share_rare_shingles_are_joined_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_CLASSES", 3)
    pick = np.random.default_rng(5)
    rows = [(at, int(pick.integers(0, 6)), int(pick.integers(8, 13)), at % 4, int(pick.integers(0, 3))) for at in range(60)]
    front = spark.createDataFrame(rows, "node long, shingle long, n_shingles long, component long, place int")
    wanted = {
        (a, b)
        for a, one, left, x, i in rows
        for b, other, right, y, j in rows
        if a < b and one == other and x != y and all(180 * (size - place) >= 80 * (left + right) for size, place in ((left, i), (right, j)))
    }
    assert wanted and sorted(map(tuple, near_dedup._meeting(front).collect())) == sorted(wanted)


def test_every_pair_over_the_bound_meets(spark):
    """Sets of few shingles that many classes share, in all sizes and overlaps."""
    pick = np.random.default_rng(8)
    texts = [(at, " ".join(f"w{word}" for word in pick.choice(13, pick.integers(1, 14), replace=False))) for at in range(150)]
    front = near_dedup._front(spark.createDataFrame(texts, "node long, text string"), 1).selectExpr("*", "node AS component")
    met = set(map(tuple, near_dedup._meeting(front).collect()))
    sets = [(at, set(text.split())) for at, text in texts]
    linked = {(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 80 * len(x | y)}
    assert len(linked) > 20 and linked <= met and len(met) < 150 * 149 / 4


def test_what_is_in_front(spark):
    """Shingles of one class only come first and are left out; as many as needed stay."""
    words = [f"w{at}" for at in range(30)]
    texts = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:20] + ["a", "b"])), (3, " ".join(words[:12]))], "node long, text string")
    found = near_dedup._front(texts, 1)
    counts = {row.node: row["count"] for row in found.groupBy("node").count().collect()}
    # 30 - 24 + 1 = 7, of which none is needed as 10 are alone; 22 - 18 + 1 = 5, less two; 12 - 10 + 1 = 3.
    assert counts == {2: 3, 3: 3}


def test_texts_of_one_id_are_judged_one_by_one(spark):
    a, b, c = prose(1, 90, 500), prose(2, 90, 500), prose(3, 90, 500)
    rows = [(3, a), (50, f"{a} more"), (50, b), (40, f"{c} more"), (50, c), (60, f"{b} more"), (70, c), (70, f"{c} end"), (70, f"{c} end")]
    found = near_dedup.near_duplicates(frame(spark, rows), 4).collect()
    text_of = {r.text_key: r.text for r in near_dedup.with_text_key(frame(spark, rows)).collect()}
    judged = sorted({(r.doc_id, text_of[r.text_key], r.component_id, r.kept) for r in found})
    assert len(found) == len(rows)
    assert judged == sorted(
        [
            (3, a, 3, True),
            (50, f"{a} more", 3, False),
            (50, b, 50, True),
            (60, f"{b} more", 50, False),
            (40, f"{c} more", 40, True),
            (50, c, 40, False),
            (70, c, 40, False),
            (70, f"{c} end", 40, False),
        ]
    )


def test_of_near_copies_with_one_id_one_stays(spark):
    text = prose(1, 90, 500)
    found = near_dedup.near_duplicates(frame(spark, [(5, text), (5, f"{text} more"), (5, f"{text} more"), (6, text)]), 4).collect()
    assert {r.component_id for r in found} == {5}
    assert len({r.text_key for r in found if r.kept}) == 1 and not [r for r in found if r.kept and r.doc_id == 6]


def test_empty_table(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).collect() == []


def test_packed_bits_count_equal_minima(spark):
    pick = np.random.default_rng(3)
    lowest = pick.integers(0, 2**32, (2, near_dedup.SIGNATURE)).astype(np.uint64)
    lowest[1, :300] = lowest[0, :300]
    packed = near_dedup.packed_bits(lowest)
    names = [f"{side}.{name}" for side in "lr" for name in near_dedup.PACKED]
    row = spark.createDataFrame([tuple(map(int, packed.reshape(-1)))], ", ".join(f"`{n}` long" for n in names))
    sides = row.selectExpr(
        *(f"struct({', '.join(f'`{s}.{n}` AS {n}' for n in near_dedup.PACKED)}) AS {s}" for s in "lr")
    )
    agreeing = (lowest[0] % 16 == lowest[1] % 16).mean()
    assert sides.select(near_dedup.estimate("l", "r")).first()[0] == pytest.approx((agreeing - 1 / 16) / (15 / 16))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(at, at + 1) for at in range(0, 60)] + [(200, 201), (5, 5)], "a long, b long")
    found = {row.node: row.component for row in components(edges).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 200: 200, 201: 200}
