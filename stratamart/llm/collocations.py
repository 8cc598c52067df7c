"""Phrases whose words attract each other, by prefix-free parsing (operator 12).

Texts are lower-cased in ASCII, cut into pieces at ``.,;:!?`` and line ends, and pieces into words
at blanks and tabs. All counts are per ``lang`` (null: ``und``), overlaps included.

1. Parse: two neighbouring words whose hash is 0 modulo ``TRIGGER`` end a chunk and begin the next
   one, so neighbours overlap by just these words and equal content is cut alike everywhere. The
   last chunk of a piece ends with a blank, its terminal symbol. The distinct chunks and how often
   the parse has each are the dictionary (a plain aggregation, reduced in each task first), which
   is packed into blocks of a few megabytes.
2. Sieve: each block counts its phrases of one to three words once per distinct chunk, weighted by
   the frequency of the chunk; a phrase belongs to the chunk in which it begins before the trigger.
   A block puts out a 48-bit hash and a count per distinct phrase, sorted and packed by hash range.
   A task adds up ranges of a bounded size and tells each block which of its hashes are frequent.
3. Count: the blocks count these phrases again, now as text, and an aggregation adds them up. So
   two phrases with one hash cost a needless row, and never change a count; within one block, equal
   64-bit hashes are taken for equal phrases.
4. Score: ``a`` of a candidate and ``l``, ``r`` of the parts of each cut are joined from these
   counts, as a part is at least as frequent as the whole. Scores are exact decimals.

A language may hold all rows and a phrase may be in all of them: chunks and phrases are reduced per
task and block before any shuffle, ranges are cut by hash, and the best of a language are taken
from the best of its salted parts. A piece is parsed as a whole, so memory follows the longest
piece. Null and empty texts have no words; an empty table has no phrases. Repeated rows count
as often as they come; ids are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import texts as tx
from .shared import prepare_workers, shuffle_partitions, stored

LONGEST = 3
TRIGGER = 8
BLOCK_BYTES = 4 << 20
#: Phrases that a range of hashes holds on average when added up, at some 30 bytes each.
RANGE_PHRASES = 1 << 21
HASH_BITS = 48
_SALTS = 16

# What ends a piece, and what lies between its words.
PIECE_ENDS = b".,;:!?\n\v\f\r"
BLANKS = b" \t"
BLANK, LINE_END = 0x20, 0x0A

_IN_PIECE = np.array([byte not in PIECE_ENDS for byte in range(256)])
_IN_WORD = np.array([byte not in PIECE_ENDS and byte not in BLANKS for byte in range(256)])


def _pair_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of each word with the one after it; the last entry has none and is not to be used."""
    return tx.mix(words * np.uint64(0x9E3779B97F4A7C15) + np.append(words[1:], np.uint64(0)))


def chunk_spans(words: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, word after the last, and whether it ends its piece, for each chunk.

    ``words`` are hashes, ``piece`` the number of the piece each word is in, ascending.
    """
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    begins = np.concatenate(([True], piece[1:] != piece[:-1]))
    # A trigger is two words of one piece, and does not begin it.
    trigger = _pair_hashes(words) % np.uint64(TRIGGER) == 0
    trigger &= ~begins & np.append(piece[1:] == piece[:-1], False)
    firsts = np.flatnonzero(begins | trigger)
    followers = np.append(firsts[1:], len(words))
    ends_piece = np.append(begins[firsts[1:]], True)
    return firsts, followers + np.where(ends_piece, 0, LONGEST - 1), ends_piece


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of spans one after another, and where each begins."""
    lengths = ends - starts
    return data[tx.ranges(starts, lengths)], np.concatenate(([0], np.cumsum(lengths)))


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, chunk`` for each chunk of the parse: a line of words that stand one blank apart."""
    for batch in batches:
        langs = batch.column("lang")
        for first_row, _, data, offsets in tx.sliced(batch.column("text")):
            lower = tx.LOWER[data]
            starts, ends, before = tx.words(lower, offsets, _IN_WORD)
            if not len(starts):
                continue
            # Pieces are runs of bytes without an end; texts end them too.
            piece_starts, _, _ = tx.words(lower, offsets, _IN_PIECE)
            piece = np.searchsorted(piece_starts, starts, "right")
            firsts, lasts, ends_piece = chunk_spans(tx.span_hashes(lower, starts, ends), piece)
            # One blank after each word; that of the last word of a piece is the terminal symbol.
            lengths = ends - starts + 1
            at = np.cumsum(lengths) - lengths
            spaced = np.full(int(lengths.sum()), BLANK, np.uint8)
            spaced[tx.ranges(at, lengths - 1)] = lower[tx.ranges(starts, lengths - 1)]
            stops = at[lasts - 1] + lengths[lasts - 1] + ends_piece
            # A line end after each, in place of the blank or of the byte after it.
            chunks, begins = _gathered(np.append(spaced, np.uint8(LINE_END)), at[firsts], stops)
            chunks[begins[1:] - 1] = LINE_END
            row = np.searchsorted(before, firsts, "right") - 1 + first_row
            column = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(firsts), [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(chunks)]
            )
            for a in range(0, len(firsts), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(row[part])), column[part].cast(pa.binary())], names=["lang", "chunk"]
                )


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dictionary in blocks of one language: chunks a line each, their frequencies, the word count."""
    waiting: dict[str, list[pa.RecordBatch]] = {}
    sizes: dict[str, int] = {}

    def block(lang: str) -> pa.RecordBatch:
        rows = pa.Table.from_batches(waiting.pop(lang)).combine_chunks()
        sizes.pop(lang)
        chunks = rows.column("chunk").cast(pa.large_binary()).combine_chunks()
        data, offsets = tx.utf8(chunks)
        frequencies = rows.column("frequency").to_numpy().astype(np.int64)
        # A blank for each word, but for the last one of a chunk that goes on; two words of that are the next one's.
        blanks = np.add.reduceat((data == BLANK).astype(np.int64), offsets[:-1])
        goes_on = data[offsets[1:] - 2] != BLANK
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang]),
                pa.array([data.tobytes()], pa.binary()),
                pa.array([frequencies.tobytes()], pa.binary()),
                pa.array([int((frequencies * (blanks - goes_on)).sum())], pa.int64()),
                pa.array([int(blanks.sum()) * LONGEST], pa.int64()),
            ],
            names=["lang", "chunks", "frequencies", "n", "phrases"],
        )

    for batch in batches:
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            part = batch.filter(pc.equal(langs, lang))
            waiting.setdefault(lang, []).append(part)
            sizes[lang] = sizes.get(lang, 0) + part.column("chunk").nbytes
            if sizes[lang] >= BLOCK_BYTES:
                yield block(lang)
        while sum(sizes.values()) > 4 * BLOCK_BYTES:  # many small languages
            yield block(max(sizes, key=sizes.get))
    for lang in list(waiting):
        yield block(lang)


class Phrases:
    """The words of a block and the phrases that begin at each."""

    def __init__(self, lines: bytes, frequencies: np.ndarray):
        self.data = np.frombuffer(lines, np.uint8)
        ends = np.flatnonzero(self.data == LINE_END)
        offsets = np.concatenate(([0], ends + 1))
        self.starts, self.stops, first = tx.words(self.data, offsets, _IN_WORD)
        self.words = tx.span_hashes(self.data, self.starts, self.stops)
        counts = np.diff(first)
        self.last = np.repeat(first[1:], counts)
        final = self.data[ends - 1] == BLANK
        place = np.arange(len(self.words))
        # Words of the overlap begin phrases in the next chunk.
        self.owned = place < self.last - np.where(np.repeat(final, counts), 0, LONGEST - 1)
        self.weights = np.repeat(frequencies, counts)

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of all phrases of a length, and their 64-bit hashes."""
        places = np.flatnonzero(self.owned & (np.arange(len(self.words)) + length <= self.last))
        return places, tx.run_hashes(self.words, length)[places]

    def text(self, place: int, length: int) -> bytes:
        return self.data[self.starts[place] : self.stops[place + length - 1]].tobytes()


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sum of their weights, and a place of each."""
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(weights, starts) if len(keys) else weights
    return keys[starts], sums, order[starts]


def _short(hashes: np.ndarray, lang: str) -> np.ndarray:
    """48 bits that also depend on the language."""
    seed = tx.span_hashes(np.frombuffer(lang.encode() or b"\0", np.uint8), np.array([0]), np.array([len(lang.encode()) or 1]))
    return tx.mix(hashes ^ seed) >> np.uint64(64 - HASH_BITS)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first: sorted or small ones compress well like that."""
    return values.view(np.uint8).reshape(len(values), 8).T.tobytes()


def _from_planes(packed: bytes, kind) -> np.ndarray:
    return np.frombuffer(packed, np.uint8).reshape(8, -1).T.copy().view(kind).reshape(-1)


def sieve(batches: Iterator[pa.RecordBatch], range_bits: int) -> Iterator[pa.RecordBatch]:
    """``range, block, hashes, counts``: the phrases of a block by hash range."""
    for batch in batches:
        for row in batch.to_pylist():
            phrases = Phrases(row["chunks"], np.frombuffer(row["frequencies"], np.int64))
            keys, weights = [], []
            for length in range(1, LONGEST + 1):
                places, hashes = phrases.of(length)
                keys.append(_short(hashes, row["lang"]))
                weights.append(phrases.weights[places])
            keys, sums, _ = _summed(np.concatenate(keys), np.concatenate(weights))
            found, begins = np.unique((keys >> np.uint64(HASH_BITS - range_bits)).astype(np.int64), return_index=True)
            parts = [slice(a, b) for a, b in zip(begins, [*begins[1:], len(keys)], strict=True)]
            for at in range(0, len(parts), 256):
                some = parts[at : at + 256]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found[at : at + 256], pa.int64()),
                        pa.array([row["block"]] * len(some), pa.int64()),
                        pa.array([_planes(keys[part]) for part in some], pa.binary()),
                        pa.array([_planes(sums[part]) for part in some], pa.binary()),
                    ],
                    names=["range", "block", "hashes", "counts"],
                )


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which values are among the wanted ones, which are sorted."""
    marks = np.zeros(1 << 20, bool)
    low = np.uint64(len(marks) - 1)
    marks[wanted & low] = True
    found = marks[values & low]
    if len(wanted):
        near = np.flatnonzero(found)
        at = np.searchsorted(wanted, values[near])
        found[near] = wanted[np.minimum(at, len(wanted) - 1)] == values[near]
    return found


def add_up(rows: pa.Table, least: int) -> pa.Table:
    """``block, hashes``: for each block those of its hashes in a range that are frequent in all."""
    blocks = rows.column("block").to_numpy()
    parts = [_from_planes(packed, np.uint64) for packed in rows.column("hashes").to_pylist()]
    counts = np.concatenate([_from_planes(packed, np.int64) for packed in rows.column("counts").to_pylist()])
    keys, sums, _ = _summed(np.concatenate(parts), counts)
    frequent = keys[sums >= least]
    wanted = [part[_among(part, frequent)] for part in parts]
    full = [at for at, part in enumerate(wanted) if len(part)]
    hashes = pa.array([_planes(wanted[at]) for at in full], pa.binary())
    return pa.Table.from_arrays([pa.array(blocks[full], pa.int64()), hashes], names=["block", "hashes"])


def count_again(blocks: pa.Table, wanted: pa.Table) -> pa.Table:
    """``lang, length, phrase, a`` of the wanted phrases of one block."""
    langs, lengths, texts, sums = [], [], [], []
    frequent = [_from_planes(packed, np.uint64) for packed in wanted.column("hashes").to_pylist()]
    for row in blocks.to_pylist() if frequent else []:
        phrases = Phrases(row["chunks"], np.frombuffer(row["frequencies"], np.int64))
        hashes = np.sort(np.concatenate(frequent))
        for length in range(1, LONGEST + 1):
            places, full = phrases.of(length)
            here = _among(_short(full, row["lang"]), hashes)
            _, weights, first = _summed(full[here], phrases.weights[places[here]])
            chosen = places[here][first]
            found, begins = _gathered(phrases.data, phrases.starts[chosen], phrases.stops[chosen + length - 1])
            texts.append(
                pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(chosen), [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(found)]
                ).cast(pa.string())
            )
            langs.append(pa.repeat(pa.scalar(row["lang"], pa.string()), len(chosen)))
            lengths.append(pa.repeat(pa.scalar(length, pa.int32()), len(chosen)))
            sums.append(pa.array(weights, pa.int64()))
    columns = {"lang": (langs, pa.string()), "length": (lengths, pa.int32()), "phrase": (texts, pa.string()), "a": (sums, pa.int64())}
    return pa.table({name: pa.chunked_array(parts, kind) for name, (parts, kind) in columns.items()})


def dictionary(documents: DataFrame) -> DataFrame:
    """``block, lang, chunks, frequencies, n, phrases``: the packed dictionary of the parse."""
    prepare_workers(documents.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    chunks = documents.select(lang, "text").mapInArrow(parse, "lang string, chunk binary")
    distinct = chunks.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("frequency"))
    packed = distinct.mapInArrow(pack, "lang string, chunks binary, frequencies binary, n long, phrases long")
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), "phrase_blocks")


def frequent_phrases(blocks: DataFrame, least: int) -> DataFrame:
    """``lang, length, phrase, a`` of all phrases of up to three words that occur often enough."""
    spark = blocks.sparkSession
    total = blocks.agg(F.coalesce(F.sum("phrases"), F.lit(0)).alias("phrases")).first()["phrases"]
    ranges = max(shuffle_partitions(spark), -(-total // RANGE_PHRASES))
    range_bits = min(max(1, (ranges - 1).bit_length()), 30)
    kept = blocks.select("block", "lang", "chunks", "frequencies")
    sieved = kept.mapInArrow(partial(sieve, range_bits=range_bits), "range long, block long, hashes binary, counts binary")

    def added(rows: pa.Table) -> pa.Table:
        return add_up(rows, least)

    wanted = sieved.groupBy("range").applyInArrow(added, "block long, hashes binary")
    counted = kept.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(
        count_again, "lang string, length int, phrase string, a long"
    )
    summed = counted.groupBy("lang", "length", "phrase").agg(F.sum("a").alias("a"))
    return stored(summed.where(F.col("a") >= least), "phrase_counts")


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 a a / (l r))`` in whole decimals of 38 digits, enough for ``a`` up to 1e16."""
    wide = [value.cast("decimal(18,0)") for value in (a, left, right)]
    product = (F.lit(1000000).cast("decimal(7,0)") * wide[0]) * wide[0]
    return F.call_function("div", product.cast("decimal(38,0)"), (wide[1] * wide[2]).cast("decimal(38,0)"))


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: ``lang, phrase, a, l, r, score``."""
    counts = phrases.select("lang", "phrase", "a")
    several = phrases.where("length > 1")
    words = F.split("phrase", " ")
    cuts = several.select(
        "lang", "phrase", "length", "a", F.posexplode(F.sequence(F.lit(1), F.col("length") - 1)).alias("cut", "first"), words.alias("words")
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "first",
        F.array_join(F.slice("words", F.lit(1), F.col("first")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("first") + 1, F.col("length")), " ").alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        part = counts.select(F.col("lang"), F.col("phrase").alias(side), F.col("a").alias(name))
        cuts = cuts.join(part, ["lang", side])
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    best = F.min(F.struct("score", "first", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(documents: DataFrame, least: int = 10, share_percent: int = 50, most: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``most`` phrases of each language.

    A phrase is left out if a longer one that contains it occurs at least ``share_percent`` of 100
    times as often. The order is by score, then ``a``, both falling, then the phrase.
    """
    blocks = dictionary(documents)
    phrases = frequent_phrases(blocks, least)
    words = F.split("phrase", " ")
    longest = phrases.where(F.col("length") == LONGEST)
    inside = longest.select(
        "lang",
        F.explode(F.array(*(F.array_join(F.slice(words, at, LONGEST - 1), " ") for at in (1, 2)))).alias("phrase"),
        F.col("a").alias("longer"),
    )
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    found = scored(phrases).join(inside, ["lang", "phrase"], "left")
    found = found.where(F.coalesce(100 * F.col("longer") < share_percent * F.col("a"), F.lit(True))).drop("longer")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    part = Window.partitionBy("lang", "salt").orderBy(*order)
    best = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= most)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = best.withColumn("rank", rank.cast("long")).where(F.col("rank") <= most)
    sizes = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
