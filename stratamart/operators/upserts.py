"""Dimensions without history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scd1_upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """The next state of a dimension: incoming rows replace or join the existing ones.

    An incoming null overwrites a value; a key that does not come in stays as it is. Both
    sides have one row per key.
    """
    old = existing.select(*keys, F.struct(*attributes).alias("old"))
    new = incoming.select(*keys, F.struct(*attributes).alias("new"))
    winner = F.coalesce("new", "old")
    joined = old.join(new, list(keys), "full_outer").select(*keys, winner.alias("row"))
    return joined.select(*keys, "row.*")
