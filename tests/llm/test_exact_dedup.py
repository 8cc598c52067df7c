from __future__ import annotations

from collections import defaultdict

from cases import SPACES, frame, odd_documents, sha

from stratamart.llm.exact_dedup import DigestIndex
from stratamart.llm.shared import with_text_key

STRIP = str.maketrans("", "", SPACES)


def norm(text):
    return (text or "").translate(STRIP)


def test_odd_documents(spark, folder):
    rows = odd_documents()
    found = DigestIndex(spark, f"{folder}/index", 4).add(frame(spark, rows)).collect()
    groups = defaultdict(list)
    for at, (doc_id, text) in enumerate(rows):
        groups[norm(text)].append((-len(text or ""), doc_id is None, doc_id or 0, at, doc_id))
    wanted = []
    for at, (doc_id, text) in enumerate(rows):
        *_, kept_at, keep = min(groups[norm(text)])
        wanted.append((doc_id, keep, len(groups[norm(text)]), at == kept_at, sha(norm(text).encode())))
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(row)[:5]) for row in found)


def test_a_second_load_meets_the_index(spark, folder):
    index = DigestIndex(spark, f"{folder}/index", 4)
    index.add(frame(spark, [(5, "a b"), (6, "ab"), (7, "c")])).collect()
    again = DigestIndex(spark, f"{folder}/index", 4)
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in again.add(frame(spark, [(1, "a  b"), (2, "d"), (3, "d")])).collect()}
    assert found == {1: (5, 1, False), 2: (2, 2, True), 3: (2, 2, False)}
    assert again.read().count() == 3
    # The same load again, as after a failure.
    repeated = {r.doc_id: r.kept for r in again.add(frame(spark, [(2, "d"), (3, "d")])).collect()}
    assert repeated == {2: False, 3: False} and again.read().count() == 3


def test_one_row_of_a_group_stays(spark, folder):
    """Rows of one id with other white space, rows that repeat one, and rows without."""
    rows = [(7, "a b"), (7, "ab"), (7, "a  b"), (7, "a  b"), (9, "a  b"), (None, "x y"), (None, "xy"), (None, "x y"), (-3, "q"), (-3, "q"), (None, "q")]
    found = DigestIndex(spark, f"{folder}/index", 4).add(frame(spark, rows))
    texts = {r.text_key: r.text for r in with_text_key(frame(spark, rows)).collect()}
    kept = [(r.doc_id, texts[r.text_key]) for r in found.collect() if r.kept]
    assert sorted(kept, key=repr) == [(-3, "q"), (7, "a  b"), (None, "x y")]
    assert {(r.keep_id, r.group_size) for r in found.collect()} == {(7, 5), (None, 3), (-3, 3)}


def test_ids_at_both_ends_of_their_range(spark, folder):
    low, high = -(2**63), 2**63 - 1
    rows = [(high, "a"), (low, "a"), (None, "a"), (high, "b"), (None, "b"), (0, "c"), (-1, "c")]
    found = {(r.doc_id, r.keep_id) for r in DigestIndex(spark, f"{folder}/index", 4).add(frame(spark, rows)).collect() if r.kept}
    assert found == {(low, low), (high, high), (-1, -1)}


def test_a_compacted_index(spark, folder):
    index = DigestIndex(spark, f"{folder}/index", 4)
    for load in range(3):
        index.add(frame(spark, [(at, f"{load} {at}") for at in range(30)])).collect()
    other = index.compacted(f"{folder}/other")
    assert other.read().count() == index.read().count() == 90
    assert len(other.read().inputFiles()) == 4 < len(index.read().inputFiles())
    found = other.add(frame(spark, [(1, "2 7"), (2, "new")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in found) == [(1, 7, False), (2, 2, True)]


def test_the_index_is_not_shuffled(spark, folder):
    index = DigestIndex(spark, f"{folder}/index", 4)
    index.add(frame(spark, [(at, str(at)) for at in range(50)])).collect()
    rows = spark.range(10).selectExpr("unhex(sha2(CAST(id AS STRING), 256)) AS digest")
    plan = index.unseen(rows)._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("SortMergeJoin") :]
    assert side.count("Exchange hashpartitioning") == 1 and "LeftAnti" in side
    assert index.unseen(rows).count() == 0


def test_empty_table(spark, folder):
    assert DigestIndex(spark, f"{folder}/index", 4).add(frame(spark, [])).collect() == []
