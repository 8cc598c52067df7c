from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

from cases import by_repr, odd_documents
from pyspark.sql import functions as F

from stratamart.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, node long, part long, place long, kids string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return sha("".join(map(encoded, row)))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][at : at + 3])) for at in range(0, len(out[-1]), 3)])
    return out


def plain(rows):
    """The rows of ``audited``, from lists of digests."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    for name in names:
        groups[name].sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf(row)))
    trees = [levels([leaf(row) for row in groups[name]]) for name in names]
    top = levels([tree[-1][0] for tree in trees])
    out = []
    for number, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            doc_id, *others, text = row
            folded, siblings = leaf(row), ""
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                folded = leaf((doc_id, *others, text if text is None else text.replace("\n", "")))
            for tree, place in ((trees[number], at), (top, number)):
                for digests in tree[:-1]:
                    first = place // 3 * 3
                    run = digests[first : first + 3]
                    siblings += "".join(run[: place - first] + run[place - first + 1 :])
                    run[place - first] = folded
                    folded, place = sha("".join(run)), place // 3
            root = top[-1][0]
            out.append((doc_id, leaf(row), trees[number][-1][0], root, sha(siblings), folded, folded == root))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, "x") for row in rows], SCHEMA)


def audited(spark, rows):
    found = merkle.audited(frame(spark, rows))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(row) for row in found.collect()]


def sourced(rows, sources):
    return [(doc_id, sources[at % len(sources)], None if at % 5 == 0 else "en", at % 7 or None, text) for at, (doc_id, text) in enumerate(rows)]


def test_odd_documents(spark):
    rows = sourced([row for row in odd_documents() if len(row[1] or "") < 70_000], [None, "a", "ä", "", "Z", "a"])
    rows += [(900 + at, "hot", "fr", None, f"line\n{at}") for at in range(200)]
    rows += [(None, "hot", None, None, "again\n")] * 3
    found = audited(spark, rows)
    assert by_repr(found) == by_repr(plain(rows))
    assert {row[-1] for row in found} == {True, False}


def test_trees_of_every_small_size(spark):
    for count in (1, 2, 3, 4, 9, 10):
        rows = [(at, "one", "en", 1, f"text\n{at}") for at in range(count)]
        assert by_repr(audited(spark, rows)) == by_repr(plain(rows))


def test_every_row_its_own_source(spark):
    rows = [(at, f"s{at}", "en", 1, "x\ny") for at in range(28)]
    assert by_repr(audited(spark, rows)) == by_repr(plain(rows))


def test_empty_table(spark):
    assert audited(spark, []) == []


def test_equal_rows_share_no_partition_by_force(spark):
    """Rows that agree in everything are numbered over several partitions."""
    rows = frame(spark, [(1, "a", "en", 1, "same")] * 400).repartition(4)
    numbered = merkle._numbered(rows.select("doc_id", "source"), ["source", "doc_id"], "number")
    found = numbered.agg(F.count_distinct("number").alias("ids"), F.min("number").alias("low"), F.max("number").alias("high"), F.count_distinct("part").alias("parts")).first()
    assert (found.ids, found.low, found.high) == (400, 0, 399) and found.parts > 1


def test_a_changed_leaf_is_found_and_only_that(spark):
    rows = frame(spark, [(at, f"s{at % 2}", "en", 1, f"text {at}") for at in range(40)])
    columns = {name: F.col(name) for name in merkle.FIELDS}
    manifest = merkle.build(rows.select("doc_id", "source", merkle.leaf_digest(columns).alias("leaf")), "source", "doc_id")
    claimed = F.when(F.col("doc_id") == 7, merkle.digest(F.lit("other"))).otherwise(F.col("leaf"))
    ways = merkle.climb(manifest, claimed).join(manifest.leaves.select("leaf_no", "doc_id"), "leaf_no")
    assert [row.doc_id for row in ways.where(F.col("folded_root") != F.lit(manifest.root)).collect()] == [7]
    assert all(len(row.siblings) == 4 for row in ways.collect())
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") != "-1"
