"""Dimensions taken from conformed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import none_null


def dimension(rows: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """The distinct combinations of key and attributes.

    A key with two names gives two rows; see ``one_row_per_key`` for one.
    """
    return rows.select(key, *attributes).distinct()


def one_row_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One whole row per key, always the same: the smallest by its other columns, nulls first.

    Each task reduces its rows to one per key before the shuffle, so a key that holds much of
    the data costs one row per task.
    """
    rest = [name for name in rows.columns if name not in keys]
    picked = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("smallest"))
    return picked.select(
        *(name if name in keys else f"smallest.{name}" for name in rows.columns)
    )


def versioned_input(
    rows: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    newest_by: str | None = None,
) -> DataFrame:
    """Rows as a versioned dimension takes them: no null keys, one set of attributes per key.

    It is the set with the greatest ``newest_by`` (the attributes breaking ties), or by
    default the smallest. The many rows are first reduced to the different sets, which a hash
    map can do; choosing among structs has to sort, but then only has a few rows left. Plain
    ``min`` in place of ``min_by`` would let Spark merge both steps into one big sort.
    """
    if newest_by is not None:
        return newest_attributes(attribute_sets(rows, keys, attributes, newest_by), keys, attributes)
    sets = rows.where(none_null(keys)).select(*keys, *attributes).distinct()
    attribute_set = F.struct(*attributes)
    chosen = F.min_by(attribute_set, attribute_set)
    return sets.groupBy(*keys).agg(chosen.alias("chosen")).select(*keys, "chosen.*")


def attribute_sets(
    rows: DataFrame, keys: Sequence[str], attributes: Sequence[str], newest_by: str
) -> DataFrame:
    """The different keys and attributes, null keys included, each with its ``newest`` date.

    It is all that both kinds of dimension need of the rows.
    """
    return rows.groupBy(*keys, *attributes).agg(F.max(newest_by).alias("newest"))


def newest_attributes(
    sets: DataFrame, keys: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """The newest attributes of each key that is not null, the attributes breaking ties."""
    chosen = F.max_by(F.struct(*attributes), F.struct("newest", *attributes))
    picked = sets.where(none_null(keys)).groupBy(*keys).agg(chosen.alias("chosen"))
    return picked.select(*keys, "chosen.*")


def rejected_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that ``versioned_input`` refuses because a part of their key is null."""
    return rows.where(~none_null(keys))


def date_dimension(rows: DataFrame, date_column: str, name: str = "OrderDateParsed") -> DataFrame:
    """One row per date that occurs, with its calendar parts. Gaps are not filled."""
    return (
        rows.select(F.col(date_column).alias(name))
        .distinct()
        .select(
            name,
            F.dayofmonth(name).alias("Day"),
            F.month(name).alias("Month"),
            F.year(name).alias("Year"),
            F.date_format(name, "MMMM").alias("MonthName"),
            F.quarter(name).alias("Quarter"),
        )
    )
