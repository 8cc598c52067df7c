"""A Merkle manifest of a dataset, and proofs by a recursive query (operator 11).

Every row is a leaf: the hash of its fields, each ``-`` if null, else its UTF-8 byte count, ``:``
and its value. Per group (``source``) the leaves ascend by key (``doc_id``); every three
consecutive digests become the hash of their hex texts, level by level, until one is left, the
subroot; a lone leaf is its own. The subroots, ordered by group, null first and else bytewise,
give the root in the same way.

``build`` stores the levels as node rows: the digests of a node's children and a link to the node
above with the place among that one's children. Links grow on the way up. ``climb`` is one
recursive query over these rows: each leaf starts with a claimed digest, and every step joins the
node above, puts out the digests of the siblings there, and folds the claimed digest with them.
All leaves climb together, a step a level, so the query has as many rounds as a tree has levels.
For it the node rows lie in buckets of their number and are not shuffled again; a step shuffles
a leaf's number, link and folded digest, and siblings are gathered once, in order of the links.

A group may hold all rows: leaves are numbered by range partitions of their order, and a node has
at most three children. Rows with one key ascend by their leaf digest; equal rows are leaves
next to each other. Null keys come first and are never tampered with. An empty table has
no root.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import shared_folder
from .shared import shuffle_partitions, stored

ARITY = 3
# No tree is higher, as three to the fortieth has more than 63 bits; leaves are numbered below 2**48.
HEIGHTS = 40
#: How many levels one shuffle builds, from blocks of 81 digests.
LEVELS = 4
NODE_BITS = 48
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROWS_SETTING = "spark.sql.cteRecursionRowLimit"


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_digest(columns: dict[str, Column]) -> Column:
    """The digest of a row whose fields are these, in order."""
    return digest(F.concat(*map(encoded, columns.values())))


def _numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows numbered from 0 in an order, by range partitions and their sizes.

    Rows that agree in ``order`` can be dealt to several partitions, hence the salt.
    """
    salted = df.withColumn("salt", F.monotonically_increasing_id())
    keys = [*order, "salt"]
    ranged = salted.repartitionByRange(shuffle_partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    placed = stored(ranged.drop("salt").withColumn("place_id", F.monotonically_increasing_id()), "merkle_order")
    placed = placed.withColumn("part", F.shiftright("place_id", 33))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    # One row for each partition, which bounds the broadcast.
    within = F.col("place_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "part").withColumn(name, F.col("offset") + within).drop("place_id", "offset")


def _power(height: Column) -> Column:
    return F.get(F.array(*(F.lit(ARITY**power) for power in range(HEIGHTS))), height)


def _div(place: Column, by: int) -> Column:
    return F.call_function("div", place, F.lit(by))


def _node(height: Column, first: Column) -> Column:
    return F.shiftleft(height.cast("long"), NODE_BITS) + first


def _link(height: Column, place: Column, n: Column, tree: Column | None = None) -> Column:
    """The link of one of ``n`` digests at a height: four times the node above plus the place in it.

    Nodes are numbered by height and first leaf; those over the subroots (no ``tree``) by the first
    of these, at heights that go on above all groups. A single digest has no link.
    """
    first = _div(place, ARITY) * _power(height + 1)
    node = _node(height + 1 + HEIGHTS, first) if tree is None else _node(height + 1, first + tree)
    return F.when(n > 1, node * 4 + place % ARITY)


def _joined(digests: Column, at: Column) -> Column:
    """The digests from a place on that become one, next to each other."""
    return F.concat(*(F.coalesce(F.get(digests, at + step), F.lit(b"")) for step in range(ARITY)))


def _raised(level: DataFrame) -> DataFrame:
    """The next ``LEVELS`` levels of trees with several digests, in one shuffle.

    ``tree, group_no, height, n, place, kids, digest``; a group has the digests of one block.
    """
    block = _div(F.col("place"), ARITY**LEVELS).alias("block")
    ordered = F.array_sort(F.collect_list(F.struct("place", "digest")))["digest"]
    rows = level.where("n > 1").groupBy("tree", "group_no", "height", "n", block).agg(ordered.alias("digests"))
    found = []
    for step in range(1, LEVELS + 1):
        below = "digests" if step == 1 else f"digests{step - 1}"
        rows = _with_step(rows, step, F.col(below))
        found.append(_step_rows(step))
    return rows.select("tree", "group_no", F.inline(F.flatten(F.array(*found))))


def _with_step(rows: DataFrame, step: int, below: Column) -> DataFrame:
    """The children and digests one level above those of a block."""
    more = F.ceil(F.col("n") / ARITY ** (step - 1)) > 1
    places = F.sequence(F.lit(0), _div(F.size(below) - 1, ARITY).cast("int"))
    kids = F.transform(places, lambda at: _joined(below, at * ARITY))
    rows = rows.withColumn(f"kids{step}", F.when(more, kids).otherwise(F.array().cast("array<binary>")))
    return rows.withColumn(f"digests{step}", F.transform(f"kids{step}", lambda kids: digest(hex_text(kids))))


def _step_rows(step: int) -> Column:
    def row(kids: Column, at: Column) -> Column:
        return F.struct(
            (F.col("height") + step).alias("height"),
            F.ceil(F.col("n") / ARITY**step).alias("n"),
            (F.col("block") * ARITY ** (LEVELS - step) + at).alias("place"),
            kids.alias("kids"),
            F.get(f"digests{step}", at).alias("digest"),
        )

    return F.transform(f"kids{step}", row)


@dataclass(frozen=True)
class Manifest:
    """The stored levels of a dataset.

    ``leaves`` has the rows given with leaf_no, part, group_no and link; ``nodes`` has node, kids and
    link; ``subroots`` has part, group_no and subroot for each range of leaves; ``root`` is binary,
    null if there are no rows.
    """

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: bytes | None


def build(rows: DataFrame, group: str, key: str) -> Manifest:
    """The manifest of ``rows``, which have a binary ``leaf`` beside the group and the key."""
    spark, folder = rows.sparkSession, shared_folder(rows.sparkSession, "merkle_nodes")
    numbered = _numbered(rows, [group, key, "leaf"], "leaf_no")
    spans = numbered.groupBy("part", group).agg(F.min("leaf_no").alias("first"), F.count(F.lit(1)).alias("size"))
    spans = stored(spans, "merkle_spans")
    groups = spans.groupBy(group).agg(F.min("first").alias("tree"), F.sum("size").alias("n"))
    groups = stored(_numbered(groups, ["tree"], "group_no").drop("part"), "merkle_groups")
    # A group's rows meet it by partition, so a group that holds most rows is no hot key.
    of_span = spans.select("part", group).join(groups.withColumnRenamed(group, "of"), F.col(group).eqNullSafe(F.col("of")))
    of_span = stored(of_span.select(F.col("part").alias("in_part"), "of", "tree", "n", "group_no"), "merkle_spans")
    met = (F.col("part") == F.col("in_part")) & F.col(group).eqNullSafe(F.col("of"))
    found = groups.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.max("n"), F.lit(0)).alias("largest")).first()
    n_groups = F.lit(found["groups"])

    def links(height: Column) -> Column:
        own = _link(height, F.col("place"), F.col("n"), F.col("tree"))
        return F.coalesce(own, _link(F.lit(0), F.col("group_no"), n_groups))

    leaves = numbered.join(of_span, met).withColumn("place", F.col("leaf_no") - F.col("tree"))
    names = [*rows.columns, "leaf_no", "part", "tree", "group_no", "n", "place"]
    leaves = stored(leaves.select(*names, links(F.lit(0)).alias("link")), "merkle_leaves")

    def grow(level: DataFrame, largest: int, name: str, node: Column, link: Column) -> list[DataFrame]:
        passes = []
        while largest > 1:
            out = _raised(level).withColumns({"node": node, "link": link})
            path = f"{folder}/tier={name}/pass={len(passes)}"
            out.write.parquet(path)
            passes.append(spark.read.schema(out.schema).parquet(path))
            largest = -(-largest // ARITY**LEVELS)
            level = passes[-1].where(F.col("height") == LEVELS * len(passes))
        return passes

    height, place = F.col("height"), F.col("place")
    first = leaves.select("tree", "group_no", F.lit(0).alias("height"), "n", "place", F.col("leaf").alias("digest"))
    own_node = _node(height, F.col("tree") + place * _power(height))
    levels = [first, *grow(first, found["largest"], "groups", own_node, links(height))]
    subroots = reduce(DataFrame.unionByName, (level.where("n = 1").select("group_no", "digest") for level in levels))
    subroots = stored(subroots, "merkle_subroots")
    zero = F.lit(0).cast("long")
    top = subroots.select(
        zero.alias("tree"), zero.alias("group_no"), F.lit(0).alias("height"), n_groups.alias("n"), F.col("group_no").alias("place"), "digest"
    )
    top_node = _node(height + HEIGHTS, place * _power(height))
    tops = [top, *grow(top, found["groups"], "top", top_node, _link(height, place, F.col("n")))]
    # One digest comes to the driver: the root.
    root = tops[-1].where("n = 1").select("digest").first()
    of_part = of_span.select(F.col("in_part").alias("part"), "group_no")
    of_part = of_part.join(subroots.withColumnRenamed("digest", "subroot"), "group_no").select("part", "group_no", "subroot")

    schema = "node long, kids binary, link long"
    grown = len(levels) + len(tops) > 2
    nodes = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder) if grown else spark.createDataFrame([], schema)
    kept = leaves.select(*rows.columns, "leaf_no", "part", "group_no", "link")
    return Manifest(kept, nodes, of_part, None if root is None else bytes(root["digest"]))


# A step is one level. Digests are hashed as hex texts; what is stored and shuffled is binary.
_CLIMB = """
WITH RECURSIVE climb(leaf_no, link, folded, siblings) AS (
    SELECT leaf_no, link, claimed, CAST(NULL AS BINARY) FROM {claims}
    UNION ALL
    SELECT c.leaf_no, n.link,
        unhex(sha2(lower(hex(overlay(n.kids PLACING c.folded FROM c.link % 4 * 32 + 1 FOR 32))), 256)),
        overlay(n.kids PLACING X'' FROM c.link % 4 * 32 + 1 FOR 32)
    FROM climb c JOIN {nodes} n ON shiftright(c.link, 2) = n.node)
SELECT leaf_no, max_by(folded, coalesce(link, {last})) AS folded_root,
    array_sort(collect_list(IF(siblings IS NULL, NULL, struct(coalesce(link, {last}) AS link, siblings)))).siblings AS siblings
FROM climb GROUP BY leaf_no
"""


def climb(manifest: Manifest, claimed: Column, **columns: Column) -> DataFrame:
    """For each leaf the way to the root from a claimed digest of its own.

    ``leaf_no``; ``folded_root``, what the claim leads to; ``siblings``, an array with the
    concatenated digests beside the way, a step each, or in its place ``columns`` made of it.
    """
    spark = manifest.leaves.sparkSession
    claims = manifest.leaves.select("leaf_no", "link", claimed.alias("claimed"))
    name, buckets = f"merkle_nodes_{uuid.uuid4().hex}", shuffle_partitions(spark)
    spark.sql(
        f"CREATE TABLE {name} (node BIGINT, kids BINARY, link BIGINT) USING parquet CLUSTERED BY (node) SORTED BY (node) "
        f"INTO {buckets} BUCKETS LOCATION '{shared_folder(spark, 'merkle_buckets')}'"
    )
    manifest.nodes.repartition(buckets, "node").select("node", "kids", "link").write.insertInto(name)
    # Spark stops a recursive query at a million rows unless told otherwise; it runs right here.
    limit = spark.conf.get(_ROWS_SETTING)
    spark.conf.set(_ROWS_SETTING, "-1")
    try:
        ways = spark.sql(_CLIMB, claims=claims, nodes=spark.table(name), last=2**63 - 1)
        made = [made.alias(column) for column, made in columns.items()] or ["siblings"]
        return stored(ways.select("leaf_no", "folded_root", *made), "merkle_climb")
    finally:
        spark.conf.set(_ROWS_SETTING, limit)
        spark.sql(f"DROP TABLE {name}")


def _tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def audited(documents: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row.

    The line ends of every other document (by the CRC of its id) are deleted after the manifest
    was built; ``verified`` says whether the climb from the digest of what is left gives the root.
    """
    columns = {name: F.col(name) for name in FIELDS}
    after = columns | {"text": F.translate("text", "\n", "")}
    leaf = leaf_digest(columns)
    claimed = F.when(_tampered(F.col("doc_id")), leaf_digest(after)).otherwise(leaf)
    rows = stored(documents.select("doc_id", "source", leaf.alias("leaf"), claimed.alias("claimed")), "merkle_rows")
    manifest = build(rows, "source", "doc_id")
    proof = F.sha2(F.concat_ws("", F.transform("siblings", hex_text)), 256)
    ways = climb(manifest, F.col("claimed"), proof_sha256=proof)
    found = manifest.leaves.select("doc_id", "leaf", "leaf_no", "part", "group_no")
    found = found.join(manifest.subroots, ["part", "group_no"]).join(ways, "leaf_no")
    root = F.lit(manifest.root).cast("binary")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        hex_text(root).alias("root"),
        "proof_sha256",
        hex_text(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == root).alias("verified"),
    )
