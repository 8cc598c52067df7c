"""Where the stored orders are: order id to SalesID and month, in buckets.

Ids that follow each other are neighbours: blocks of 65,536 ids are hashed into 32,768 slots, and
slots are dealt to buckets. New orders mostly have new ids in a row, so they fall into few
slots. The slots of an extract are a Bloom filter of its ids with one hash function: a bitmap of
4,096 bytes, however large the extract is. It tells which buckets need to be opened at all,
and drops rows of other slots while these are scanned, before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.facts import year_month

BLOCK_BITS = 16
SLOTS = 1 << 15
COLUMNS = ["OrderID", "SalesID", "yearmonth"]
SCHEMA = "OrderID {id_type}, SalesID bigint, yearmonth string"


def slot(order_id: str = "OrderID") -> Column:
    """Where the block of an order id lies, from 0."""
    block = F.shiftright(F.col(order_id).cast("bigint"), BLOCK_BITS)
    return F.pmod(F.xxhash64(block), F.lit(SLOTS)).cast("int")


def entries(fact: DataFrame) -> DataFrame:
    """The index rows of fact rows."""
    return fact.select("OrderID", "SalesID", year_month("OrderDate"))


class SlotFilter:
    """The slots that the ids of some orders fall into."""

    def __init__(self, bitmap: bytes):
        self.bitmap = bytes(bitmap)

    @classmethod
    def of(cls, orders: DataFrame) -> SlotFilter:
        # Bits are numbered from 1 by this function, and bytes hold the lowest bit first.
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(slot().cast("bigint") + 1))
        return cls(orders.agg(bits.alias("bits")).first()["bits"])

    def slots(self) -> list[int]:
        return [at for at in range(SLOTS) if self.bitmap[at >> 3] >> (at & 7) & 1]

    def buckets(self, count: int) -> set[int]:
        return {at % count for at in self.slots()}

    def may_have(self) -> Column:
        """Whether a row can be among these orders, by its slot."""
        words = [int.from_bytes(self.bitmap[at : at + 8], "little", signed=True) for at in range(0, len(self.bitmap), 8)]
        word = F.get(F.lit(words).cast("array<bigint>"), F.shiftright(slot(), 6))
        bit = (slot() % 64).cast("int")
        return F.call_function("getbit", word, bit) == 1


def bucketed(rows: DataFrame, count: int) -> DataFrame:
    """Index rows ready to be written by ``bucket``: one sorted file each."""
    placed = rows.select(*COLUMNS, (slot() % count).alias("bucket"))
    return placed.repartition("bucket").sortWithinPartitions("bucket", slot(), "OrderID")
