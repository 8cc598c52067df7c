"""Facts joined to the dimension version in force at their date."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import none_null


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: dict[str, str],
    date_column: str,
    columns: Sequence[str],
    splits: int = 1,
    by_month: bool = False,
) -> DataFrame:
    """Every fact with ``columns`` of its dimension version, or nulls if there is none.

    ``keys`` maps fact columns to dimension columns. The key equality carries the join; the
    dates are checked on its matches. A version lasts a day or more, so a key has at most as
    many versions as there were runs.

    Adaptive execution splits a key with very many facts by itself. Where it cannot (another
    step needs the same partitioning, or it is off), ``splits`` spreads the facts of each
    key over that many tasks and copies the versions to each, which keeps the result as is.

    ``by_month`` suits dimensions with many versions per key, such as stock that changes every
    day: closed versions are joined by key and month, so a fact meets a month of them instead
    of all; of open versions a key has one at most. Long-lived versions are copied into each of
    their months, so it does not suit dimensions that rarely change.
    """
    if by_month:
        return _by_month(facts, versions, keys, date_column, columns)
    dim_columns = list(dict.fromkeys([*columns, *keys.values(), "valid_from", "valid_to"]))
    dim = versions.select(*(F.col(name).alias(f"dim_{name}") for name in dim_columns))
    left = facts

    condition = (F.col(date_column).cast("date") >= F.col("dim_valid_from")) & (
        F.col("dim_valid_to").isNull() | (F.col(date_column).cast("date") < F.col("dim_valid_to"))
    )
    for fact_key, dim_key in keys.items():
        condition &= F.col(fact_key) == F.col(f"dim_{dim_key}")
    if splits > 1:
        # Taken from the row itself, so that a recomputed task places its rows alike.
        salt = F.pmod(F.xxhash64(*facts.columns), F.lit(splits)).cast("int")
        left = left.withColumn("fact_split", salt)
        copies = F.explode(F.sequence(F.lit(0), F.lit(splits - 1)))
        dim = dim.withColumn("dim_split", copies)
        condition &= F.col("fact_split") == F.col("dim_split")

    joined = left.join(dim, condition, "left")
    return joined.select(
        *facts.columns, *(F.col(f"dim_{name}").alias(name) for name in columns)
    )


def _by_month(
    facts: DataFrame,
    versions: DataFrame,
    keys: dict[str, str],
    date_column: str,
    columns: Sequence[str],
) -> DataFrame:
    date = F.col(date_column).cast("date")
    own = F.struct(*columns).alias("version")

    def dim(rows: DataFrame, prefix: str, *more) -> DataFrame:
        named = [F.col(name).alias(f"{prefix}_{name}") for name in keys.values()]
        dates = [F.col(name).alias(f"{prefix}_{name}") for name in ("valid_from", "valid_to")]
        return rows.select(*named, *dates, own.alias(f"{prefix}_version"), *more)

    def same_key(prefix: str):
        return reduce(and_, (F.col(a) == F.col(f"{prefix}_{b}") for a, b in keys.items()))

    last_day = F.date_sub("valid_to", 1)
    lasting = versions.where("valid_to > valid_from")
    months = F.sequence(
        F.trunc("valid_from", "month"), F.trunc(last_day, "month"), F.expr("INTERVAL 1 MONTH")
    )
    closed = dim(lasting, "closed", F.explode(months).alias("closed_month"))
    open_ones = dim(versions.where("valid_to IS NULL"), "open")
    in_closed = same_key("closed") & (F.trunc(date, "month") == F.col("closed_month"))
    in_closed &= (date >= F.col("closed_valid_from")) & (date < F.col("closed_valid_to"))
    in_open = same_key("open") & (date >= F.col("open_valid_from"))
    joined = facts.join(closed, in_closed, "left").join(open_ones, in_open, "left")
    found = F.coalesce("closed_version", "open_version")
    return joined.select(*facts.columns, *(found[name].alias(name) for name in columns))


def as_of_carry_forward(
    facts: DataFrame,
    versions: DataFrame,
    keys: dict[str, str],
    date_column: str,
    columns: Sequence[str],
) -> DataFrame:
    """``as_of_join`` without a fact meeting more than one version, whatever the dimension is like.

    The facts of a key and day are a slice: all of them have the same version. Slices and versions
    are put in order by key and date, and the last version is carried forward from slice to slice;
    then each fact takes the one of its slice. A key has a slice a day at most, into which each task
    reduces its facts before the shuffle, so neither a key with a third of all facts nor one with
    a thousand versions makes a long group, no version is copied, and the facts of a hot key are
    dealt out by day.

    Versions of a key must not overlap, which those of this library never do.
    """
    day = F.col(date_column).cast("date")
    named = [F.col(name).alias(f"slice_{at}") for at, name in enumerate(keys)]
    own = [f"slice_{at}" for at in range(len(keys))]
    found = none_null([*own, "slice_day"])
    slices = facts.select(*named, day.alias("slice_day")).where(found).distinct()
    # A version that ends on the day it begins was never in force.
    lasting = versions.where("valid_to IS NULL OR valid_to > valid_from")
    begins = lasting.select(
        *(F.col(name).alias(f"slice_{at}") for at, name in enumerate(keys.values())),
        F.col("valid_from").alias("slice_day"),
        F.struct(F.col("valid_to").alias("until"), F.struct(*columns).alias("columns")).alias("version"),
    )
    no_version = F.lit(None).cast(begins.schema["version"].dataType)
    both = slices.withColumns({"version": no_version, "asked": F.lit(True)}).unionByName(
        begins.where(found).withColumn("asked", F.lit(False))
    )
    # One row for a key and day, be it a slice, the begin of a version, or both.
    both = both.groupBy(*own, "slice_day").agg(F.first("version", ignorenulls=True).alias("version"), F.max("asked").alias("asked"))
    so_far = Window.partitionBy(*own).orderBy("slice_day").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("version", F.last("version", ignorenulls=True).over(so_far)).where("asked")
    in_force = F.col("version.until").isNull() | (F.col("slice_day") < F.col("version.until"))
    valid = carried.select(*own, "slice_day", F.when(in_force, F.col("version.columns")).alias("found_columns"))
    same = reduce(and_, (F.col(name) == F.col(f"slice_{at}") for at, name in enumerate(keys)))
    joined = facts.join(valid, same & (day == F.col("slice_day")), "left")
    return joined.select(*facts.columns, *(F.col(f"found_columns.{name}").alias(name) for name in columns))
