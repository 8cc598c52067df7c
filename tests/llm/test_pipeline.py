from __future__ import annotations

import public_tokenizers
import pytest
from cases import CLASHING, by_repr, frame, near_components, odd_documents, prose
from pyspark.sql import functions as F
from test_decontaminate import ITEMS, plain
from test_exact_dedup import norm
from test_quality import labelled

import corpus_pipeline as cp
from stratamart.llm import byte_bpe
from stratamart.llm.quality import quality_scores

MORE = ["row", "same_text", "named", "docs", "rejected_id", "predicted", "contaminated"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(labelled()[1], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def documents(spark):
    rows = odd_documents() + [(300, f"{prose(30, 9, 900)} {prose(1, 20, 500)}"), (301, prose(31, 90, 900))]
    return frame(spark, rows).withColumns({name: F.lit(1) for name in MORE})


def pairs(df):
    return [(row.doc_id, row.text) for row in df.collect()]


def test_stages_take_and_return_documents(spark, documents, sf_dir):
    assert [name for name, _ in cp.STAGES] == [
        "quality classifier",
        "exact dedup",
        "MinHash near-dedup",
        "benchmark decontamination",
        "byte-level BPE",
    ]
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, documents, sf_dir).schema.names == ["doc_id", "text", *CLASHING, *MORE]
        assert stage(spark, documents.limit(0), sf_dir).collect() == []


def test_quality(spark, sf_dir):
    docs = frame(spark, labelled()[0] + odd_documents())
    scores = quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = [(row.doc_id, row.text_key) for row in scores.where("predicted = 1 OR doc_id IS NULL").collect()]
    kept = cp.good_quality(spark, docs, sf_dir).select("doc_id", F.xxhash64("doc_id", "text"))
    assert by_repr(map(tuple, kept.collect())) == by_repr(good)
    truth = dict(labelled()[1])
    wrong = [i for i, _ in pairs(cp.good_quality(spark, docs, sf_dir)) if i is not None and truth.get(i) == 0]
    assert len(wrong) < 4


def test_exact(spark, documents, sf_dir):
    kept = pairs(cp.once_exactly(spark, documents, sf_dir))
    rows = pairs(documents)
    named = [row for row in kept if row[0] is not None]
    assert len({norm(text) for _, text in named}) == len(named)
    assert {norm(text) for _, text in rows} == {norm(text) for _, text in kept}
    for doc_id, text in named:
        equal = [(-len(t or ""), i) for i, t in rows if i is not None and norm(t) == norm(text)]
        assert (-len(text or ""), doc_id) == min(equal)


def test_exact_leaves_one_row_of_equal_texts(spark, sf_dir):
    """White space, rows of one id, rows without, and a column that has no order."""
    rows = [(7, "a b"), (7, "ab"), (7, "a  b"), (7, "a  b"), (9, "a  b"), (None, "x y"), (None, "xy"), (None, "x y"), (8, "q"), (None, "q"), (None, None)]
    docs = frame(spark, rows, clashing=False).withColumn("more", F.create_map(F.lit("k"), F.rand(1)))
    kept = cp.once_exactly(spark, docs, sf_dir)
    assert kept.columns == ["doc_id", "text", "more"]
    assert by_repr(pairs(kept)) == by_repr([(7, "a  b"), (None, "x y"), (8, "q"), (None, None)])


def test_near(spark, documents, sf_dir):
    rows = pairs(documents)
    component = near_components(rows, 5)
    kept = pairs(cp.once_nearly(spark, documents, sf_dir))
    assert by_repr(kept) == by_repr(row for row in rows if row[0] is None or component[row[0]] == row[0])


def test_near_keeps_other_texts_of_an_id(spark, sf_dir):
    a, b = prose(41, 90, 500), prose(42, 90, 500)
    rows = frame(spark, [(3, a), (50, f"{a} more"), (50, b)])
    assert by_repr(pairs(cp.once_nearly(spark, rows, sf_dir))) == by_repr([(3, a), (50, b)])


def test_contamination(spark, documents, sf_dir):
    rows = pairs(documents)
    clean = [row for row, judged in zip(rows, plain(rows, ITEMS), strict=True) if row[0] is None or not judged[-1]]
    kept = pairs(cp.free_of_benchmark(spark, documents, sf_dir))
    assert by_repr(kept) == by_repr(clean) and len(clean) < len(rows)


def test_ids(spark, documents, sf_dir):
    bpe = byte_bpe.tokenizer(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    found = [(row.doc_id, bpe.decode(row.ids)[0].tobytes().decode()) if row.ids else (row.doc_id, "") for row in cp.as_ids(spark, documents, sf_dir).collect()]
    assert by_repr(found) == by_repr((i, text or "") for i, text in pairs(documents))


def test_run(spark, documents, sf_dir):
    documents.write.parquet(f"{sf_dir}/documents.parquet")
    stage_by_stage = documents
    for _, stage in cp.STAGES:
        stage_by_stage = stage(spark, stage_by_stage, sf_dir)
    assert by_repr(cp.run(spark, sf_dir).collect()) == by_repr(stage_by_stage.collect())
