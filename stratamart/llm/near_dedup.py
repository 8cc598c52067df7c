"""Near duplicates by b-bit MinHash (operator 7).

Texts are lower-cased in ASCII and split at ASCII white space. The set of a document holds the
64-bit hashes of its distinct shingles of ``length`` words; a shorter text is one shingle, a text
without words has none. Documents are linked when ``100 * intersection >= 80 * union``.

1. One pass over the texts makes, for each document, the digest of its set, 96 minima of the
   set and of these 24 band keys of four minima each. Documents with one digest form a class;
   only classes go on.
2. Classes that share a band with another get a b-bit signature: the lowest four bits of 512
   minima, packed into 32 numbers. Two sets agree in a minimum's bits with probability
   ``J + (1 - J) / 16``, so counting bits estimates their similarity.
3. A band bucket pairs every class with the smallest class of the bucket, which is one row per
   class and band however large the bucket is. Pairs estimated far below the bound are left
   out, the rest are confirmed on full sets.
4. Classes of buckets with several components are left. Their shingles are put in order, those in
   fewest classes first; two sets that are similar enough share one of the first
   ``n - ceil(0.8 n) + 1`` of either, at places that leave room for all others they must share, and
   shingles of one class only cannot be it. So classes that share much text but not enough, such as
   pages of one template, mostly do not meet at all. Those that do, in other components, are
   estimated and confirmed as before. A
   shingle that many classes have in front is joined block by block. Pairs inside one component
   change nothing and are never formed.

A link at 0.8 shares no band with probability below 4e-6 and is estimated below 0.719 with
probability below 1e-5 (4.4 standard deviations); every other link of different texts is found.

Null and empty texts have no shingles, are kept and linked with nothing. Rows that repeat a
doc_id with other text are judged one by one: each is linked by its own text only, so rows of
one doc_id can be in different components. Of a component the smallest doc_id is kept, and of
its rows in that component those with the smallest ``text_key``. Rows repeating doc_id and text
are one document, kept or not together. Rows without doc_id take part in no link, are kept and
have no component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx
from .graph import components
from .shared import prepare_workers, stored, with_text_key

BOUND_PERCENT = 80
BANDS, ROWS = 24, 4
MINIMA = BANDS * ROWS
SIGNATURE = 512
BITS = 4
PACKED = [f"s{at}" for at in range(SIGNATURE * BITS // 64)]
ESTIMATE_AT_LEAST = 0.719
BLOCK_CLASSES = 1000


def shingle_sets(column: pa.Array, length: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for first_row, last_row, data, offsets in tx.sliced(column):
        lower = tx.LOWER[data]
        starts, ends, first = tx.words(lower, offsets, tx.NOT_SPACE)
        hashes = tx.span_hashes(lower, starts, ends)
        runs = tx.run_hashes(hashes, length)
        for row in range(last_row - first_row):
            a, b = int(first[row]), int(first[row + 1])
            if b - a >= length:
                found = np.sort(runs[a : b - length + 1])
                yield found[np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))]
            else:
                yield tx.run_hashes(hashes[a:b], b - a) if b > a else runs[:0]


def minima(sets: list[np.ndarray], number: int) -> np.ndarray:
    """One row of 32-bit minima per set, which is not empty."""
    values = np.concatenate(sets)
    begins = np.cumsum([0, *map(len, sets[:-1])])
    factors = tx.numbered(5000, number) | np.uint64(1)
    out = np.empty((len(sets), number), np.uint64)
    for at, factor in enumerate(factors):
        out[:, at] = np.minimum.reduceat(values * factor, begins)
    return out >> np.uint64(32)


def band_keys(lowest: np.ndarray) -> np.ndarray:
    parts = lowest.reshape(len(lowest), BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for row in range(ROWS):
        keys = tx.mix(keys ^ parts[:, :, row])
    return keys.view(np.int64)


def packed_bits(lowest: np.ndarray) -> np.ndarray:
    per_number = 64 // BITS
    low = (lowest & np.uint64((1 << BITS) - 1)).reshape(len(lowest), len(PACKED), per_number)
    shifts = np.arange(per_number, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shifts, axis=2).view(np.int64)


def sketch(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sets = list(shingle_sets(part.column("text"), length))
            full = [i for i, found in enumerate(sets) if len(found)]
            keys = band_keys(minima([sets[i] for i in full], MINIMA)) if full else np.zeros((0, BANDS), np.int64)
            offsets = np.concatenate(([0], np.cumsum([BANDS * bool(len(found)) for found in sets])))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array([len(found) for found in sets], pa.int64()),
                    pa.array([hashlib.blake2b(f.tobytes(), digest_size=16).digest() if len(f) else None for f in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.reshape(-1))),
                ],
                names=["doc_id", "text_key", "n_shingles", "digest", "bands"],
            )


def sign(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The packed signature of each text that has words."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sets = list(shingle_sets(part.column("text"), length))
            full = [i for i, found in enumerate(sets) if len(found)]
            if not full:
                continue
            packed = packed_bits(minima([sets[i] for i in full], SIGNATURE))
            sizes = pa.array([len(sets[i]) for i in full], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("node").take(pa.array(full)), sizes, *map(pa.array, packed.T.copy())], names=["node", "n_shingles", *PACKED]
            )


def confirm(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Of pairs with both texts those whose full sets are similar enough."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            linked = []
            for left, right in zip(shingle_sets(part.column("text_a"), length), shingle_sets(part.column("text_b"), length), strict=True):
                both = np.intersect1d(left, right, assume_unique=True).size
                union = len(left) + len(right) - both
                linked.append(bool(union) and 100 * both >= BOUND_PERCENT * union)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))


def list_shingles(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each text."""
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part = batch.slice(at, 100)
            sets = list(shingle_sets(part.column("text"), length))
            sizes = np.array([len(found) for found in sets], np.int64)
            nodes = np.repeat(part.column("node").to_numpy(), sizes)
            shingles = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(np.repeat(sizes, sizes)), pa.array(shingles)], names=["node", "n_shingles", "shingle"]
            )


def _front(texts: DataFrame, length: int) -> DataFrame:
    """``place, shingle, node, n_shingles``: the rarest shingles of each class that others have too.

    As many as are needed for two sets over the bound to share one, with their places in the order,
    from 0. A class is one row of its shingles while they are put in order.
    """
    own = stored(texts.mapInArrow(partial(list_shingles, length=length), "node long, n_shingles long, shingle long"), "near_shingles")
    shared = own.groupBy("shingle").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    ordered = F.array_sort(F.collect_list(F.struct("classes", "shingle")))
    listed = own.join(shared, "shingle").groupBy("node", "n_shingles").agg(ordered.alias("shared"))
    # Shingles of no other class come first in the order, and are not listed.
    needed = F.col("n_shingles") - F.ceil(F.col("n_shingles") * BOUND_PERCENT / 100) + 1
    alone = F.col("n_shingles") - F.size("shared")
    left = F.greatest(F.lit(0), needed - alone).cast("int")
    front = F.posexplode(F.slice("shared", F.lit(1), left)["shingle"]).alias("place", "shingle")
    return listed.select("node", "n_shingles", alone.alias("alone"), front).withColumn("place", F.col("place") + F.col("alone")).drop("alone")


def _meeting(front: DataFrame) -> DataFrame:
    """``a, b``: classes of different components that share a shingle early enough in both.

    Sets over the bound share ``80 (n + m) / 180`` shingles or more, none of which comes before the
    first shared one, so that one is not behind the ``n`` less so many others, on either side.
    ``front`` has ``place, shingle, node, n_shingles, component``. A shingle with many classes is
    dealt into blocks, and each pair of blocks is a key of its own.
    """
    groups = front.groupBy("shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("classes")
    )
    blocks = F.ceil(F.col("classes") / BLOCK_CLASSES).cast("int")
    rows = front.join(groups.where("low <> high").select("shingle", blocks.alias("blocks")), "shingle")
    block, other = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = rows.withColumn("l_block", block).withColumn("r_block", other).alias("l")
    right = rows.withColumn("r_block", block).withColumn("l_block", other).alias("r")
    common = F.ceil(BOUND_PERCENT * (F.col("l.n_shingles") + F.col("r.n_shingles")) / (100 + BOUND_PERCENT))
    early = [F.col(f"{side}.place") + common <= F.col(f"{side}.n_shingles") for side in "lr"]
    wanted = (F.col("l.node") < F.col("r.node")) & (F.col("l.component") != F.col("r.component")) & early[0] & early[1]
    for name in ("shingle", "l_block", "r_block"):
        wanted &= F.col(f"l.{name}") == F.col(f"r.{name}")
    return left.join(right, wanted).select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct()


def _estimated(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Of pairs of classes those whose signatures are similar enough."""
    found = pairs.join(signed.alias("l"), F.col("a") == F.col("l.node"))
    found = found.join(signed.alias("r"), (F.col("b") == F.col("r.node")) & similar_enough("l", "r"))
    return found.select("a", "b")


def estimate(left: str, right: str):
    """Similarity from the packed bits, corrected for bits that agree by chance."""
    differing = F.lit(0)
    for name in PACKED:
        bits = F.col(f"{left}.{name}").bitwiseXOR(F.col(f"{right}.{name}"))
        # Fold the bits of each minimum onto its lowest one.
        for shift in (1, 2):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift))
        differing += F.bit_count(bits.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 1 / 2**BITS
    return ((1 - differing / SIGNATURE) - chance) / (1 - chance)


def similar_enough(left: str, right: str):
    small, large = F.least(f"{left}.n_shingles", f"{right}.n_shingles"), F.greatest(f"{left}.n_shingles", f"{right}.n_shingles")
    return (100 * small >= BOUND_PERCENT * large) & (estimate(left, right) >= ESTIMATE_AT_LEAST)


def _confirmed(pairs: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge")
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")).hint("merge")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return stored(both.mapInArrow(partial(confirm, length=length), "a long, b long"), "near_links")


def near_duplicates(documents: DataFrame, length: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_key`` for every row of ``documents``."""
    prepare_workers(documents.sparkSession)
    docs = with_text_key(documents)
    schema = "doc_id long, text_key long, n_shingles long, digest binary, bands array<long>"
    sketches = stored(docs.mapInArrow(partial(sketch, length=length), schema), "near_sketches")

    named = sketches.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    # Classes get numbers of their own, as several can have one doc_id. The numbers follow the
    # smallest rows of the classes, so the smallest number of a component is that of its smallest row.
    first = named.groupBy("digest").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    ordered = first.select("digest", "first.*").orderBy("doc_id", "text_key", "digest")
    classes = stored(ordered.withColumn("node", F.monotonically_increasing_id()), "near_classes")
    nodes = stored(named.join(classes, ["digest", "doc_id", "text_key"]).select("node", "bands").distinct(), "near_nodes")

    bands = nodes.select("node", F.explode("bands").alias("band"))
    buckets = stored(
        bands.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot <> last").select("band", "pivot"),
        "near_buckets",
    )
    members = stored(bands.join(buckets, "band"), "near_members")

    # The joins with texts ask for a merge, so that small tables take the plan of large ones.
    active = classes.select("doc_id", "text_key", "node").join(members.select("node").distinct(), "node", "left_semi")
    named_texts = docs.join(active.hint("merge"), ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    texts = stored(named_texts.select("node", "text"), "near_texts")
    schema = f"node long, n_shingles long, {', '.join(f'{name} long' for name in PACKED)}"
    signed = stored(texts.mapInArrow(partial(sign, length=length), schema), "near_signed")

    stars = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    stars = stored(_estimated(stars, signed), "near_stars")
    links = _confirmed(stars, texts, length)
    labels = components(links)

    # What is left: classes of different components within a bucket.
    placed = members.join(labels, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band")
    open_ones = stored(placed.join(mixed, "band").select("node", "component").distinct(), "near_open")
    if not open_ones.isEmpty():
        front = _front(texts.join(open_ones.hint("merge"), "node", "left_semi"), length)
        front = stored(front.join(open_ones, "node"), "near_front")
        rest = stored(_meeting(front).join(stars, ["a", "b"], "left_anti"), "near_meeting")
        more = _confirmed(stored(_estimated(rest, signed), "near_rest"), texts, length)
        if not more.isEmpty():
            labels = components(links.unionByName(more))

    # The smallest row of each component, for its classes; other classes have their own.
    owners = classes.select(F.col("node").alias("component"), F.struct("doc_id", "text_key").alias("owner"))
    owned = labels.join(owners, "component").select("node", "owner")
    own = F.coalesce("owner", F.struct("doc_id", "text_key")).alias("owner")
    judged = classes.join(owned, "node", "left").select("digest", own)
    grouped = sketches.select("doc_id", "text_key", "n_shingles", "digest").join(judged, "digest", "left")
    named_row = F.col("doc_id").isNotNull()
    component = F.when(named_row, F.coalesce("owner.doc_id", "doc_id"))
    kept = F.when(named_row, (F.col("doc_id") == F.col("owner.doc_id")) & (F.col("text_key") == F.col("owner.text_key")))
    return grouped.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(kept, F.lit(True)).alias("kept"), "text_key"
    )
