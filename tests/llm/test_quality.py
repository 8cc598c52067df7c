from __future__ import annotations

import zlib

import numpy as np
from cases import frame, odd_documents, prose

from stratamart.llm import quality


def labelled():
    """Prose is good; shouted, symbol-ridden and repeating texts are not."""
    rows, labels = [], []
    for doc_id in range(1000, 1600):
        text = prose(doc_id, 40 + doc_id % 50, 800)
        good = doc_id % 3 != 0
        if not good:
            text = [text.upper() + "!!", " ".join(f"{w}***" for w in text.split()), f"{text[:60]} " * 6][doc_id // 3 % 3]
        rows.append((doc_id, text))
        labels.append((doc_id, int(good)))
    return rows, labels


def test_scores_of_held_out_and_odd_documents(spark):
    rows, labels = labelled()
    every = rows + odd_documents()
    labels += [(None, 1), (1010, None), (1011, 1), (1011, 1), (77777, 0)]
    known = spark.createDataFrame([(*label, 0) for label in labels], "doc_id long, quality int, toxic int")
    found = quality.quality_scores(frame(spark, every), known).collect()
    assert sorted(map(repr, (row.doc_id for row in found))) == sorted(map(repr, (i for i, _ in every)))
    truth, right, held = dict(labels), 0, 0
    for row in found:
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7)
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        if row.held_out and row.doc_id >= 1000 and truth[row.doc_id] is not None:
            held, right = held + 1, right + (row.predicted == truth[row.doc_id])
    assert held > 100 and right / held > 0.97


def test_held_out_labels_and_other_columns_are_never_used(spark):
    rows, labels = labelled()
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    scores = []
    for known in (labels, turned):
        table = spark.createDataFrame(known, "doc_id long, quality int")
        scores.append({row.doc_id: row.score for row in quality.quality_scores(frame(spark, rows), table).collect()})
    assert scores[0] == scores[1]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_scores(frame(spark, []), none).collect() == []
    found = quality.quality_scores(frame(spark, odd_documents()), none).collect()
    assert {row.score for row in found} == {0.5}


def test_pairs_of_numbers_are_learnt():
    pick = np.random.default_rng(1)
    values = pick.random((4000, 3))
    labels = ((values[:, 0] > 0.5) ^ (values[:, 1] > 0.5)).astype(float)
    model = quality.fit(values, labels)
    test = pick.random((1000, 3))
    right = (model.score(test) > 0.5) == ((test[:, 0] > 0.5) ^ (test[:, 1] > 0.5))
    assert right.mean() > 0.9 and (1, 0) in model.pairs


def test_the_sum_of_table_entries_is_the_score():
    pick = np.random.default_rng(2)
    values = pick.random((500, 4))
    model = quality.fit(values, (values[:, 2] > 0.3).astype(float))
    for row in values[:20]:
        total = model.base
        for at, value in enumerate(row):
            total += model.tables[at][sum(value >= edge for edge in model.edges[at])]
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            total += table[sum(row[a] >= e for e in model.pair_edges[a])][sum(row[b] >= e for e in model.pair_edges[b])]
        assert abs(model.score(row[None])[0] - 1 / (1 + np.exp(-total))) < 1e-12


def test_labels_without_documents_do_not_thin_the_sample(spark):
    """Of a hundred times as many labels only few have documents, and these are all learnt from."""
    from stratamart.llm.shared import hashed_sample

    rows = spark.range(300).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text")
    found = hashed_sample(rows, 200, 1_000_000, ["text"])
    assert [row.doc_id for row in found] == [row.doc_id for row in hashed_sample(rows, 200, 300, ["text"])]
    assert len(found) == 200 and len(hashed_sample(rows, 500, 1_000_000, ["text"])) == 300
    assert hashed_sample(rows.limit(0), 5, 1_000_000, ["text"]) == []
