"""Dense surrogate keys without passing all rows through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A key is cut into digits of 16 bits, so no group below holds more than 65,536 entries.
DIGIT_BITS = 16
KEY_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def with_surrogate_key(df: DataFrame, name: str, order_by: str, start: int = 0) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in order of an integer column.

    ``order_by`` has to be unique and not null, as an order id is after conforming. The ids
    depend on its values alone, not on partitions, so recomputed tasks give the same ids.

    Rows sharing all but the last digit form a block of at most 65,536 rows, numbered by
    itself. How many rows precede a block follows from the block sizes: for an int
    there are at most 65,536 blocks, which are small enough to add up at once and to
    broadcast; a bigint repeats the step on the blocks, then on the blocks of blocks.
    """
    digits = KEY_BITS[dict(df.dtypes)[order_by]] // DIGIT_BITS
    block = F.shiftright(F.col(order_by), DIGIT_BITS).alias("block")
    sizes = df.select(block).groupBy("block").agg(F.count(F.lit(1)).alias("size"))
    offsets = _offsets(sizes, digits - 1)
    if digits <= 2:
        offsets = F.broadcast(offsets)
    within = F.row_number().over(Window.partitionBy("block").orderBy(order_by))
    numbered = df.withColumn("block", block).withColumn("within", within)
    # An ordinary equality would make Spark filter both sides for nulls, in different places,
    # and then compute df twice; the null-safe one lets them share its last shuffle.
    same_block = F.col("block").eqNullSafe(F.col("offset_block"))
    position = F.col("preceding") + F.col("within") + F.lit(start - 1)
    return numbered.join(
        offsets.withColumnRenamed("block", "offset_block"), same_block
    ).select(*df.columns, position.cast("bigint").alias(name))


def _offsets(sizes: DataFrame, digits: int) -> DataFrame:
    """For each block the number of rows in all blocks before it.

    ``digits`` is how many digits the block numbers have; the sums never run over more than
    the blocks that differ in the last one.
    """
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    preceding = F.coalesce(F.sum("size").over(before), F.lit(0))
    if digits <= 1:
        return sizes.select("block", preceding.alias("preceding"))

    parent = F.shiftright("block", DIGIT_BITS)
    before = Window.partitionBy("parent").orderBy("block")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    preceding = F.coalesce(F.sum("size").over(before), F.lit(0))
    local = sizes.withColumn("parent", parent).select(
        "block", "parent", preceding.alias("local")
    )
    parents = sizes.groupBy(parent.alias("block")).agg(F.sum("size").alias("size"))
    upper = _offsets(parents, digits - 1).withColumnsRenamed(
        {"block": "upper_parent", "preceding": "upper"}
    )
    total = (F.col("upper") + F.col("local")).alias("preceding")
    same_parent = F.col("parent").eqNullSafe(F.col("upper_parent"))
    return local.join(upper, same_parent).select("block", total)
