"""Dimensions with history: one row per version, valid in ``[valid_from, valid_to)``.

The version in force has no ``valid_to`` and ``is_current`` set. An incoming frame has one
row per key and no null keys (see ``versioned_input``); the existing frame has at most one
current row per key. Keys that do not come in keep their current version, and keys that have
closed versions only are opened again when they come in.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import any_changed, none_null
from ..schemas import VERSION_COLUMNS

EXPIRED = "expired"
NEW_VERSION = "new version"
NEW_KEY = "new key"
UNCHANGED = "unchanged"
HISTORY = "history"


def scd2_bootstrap(incoming: DataFrame, run_date: datetime.date) -> DataFrame:
    """The first state of a dimension: every row current from the run date on."""
    return incoming.withColumns(
        {
            "valid_from": F.lit(run_date),
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def scd2_changed(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    null_safe: bool = True,
) -> DataFrame:
    """Current rows whose attributes come in with other values, as ``old_*`` and ``new_*``."""
    old = existing.where("is_current").select(*keys, F.struct(*attributes).alias("old"))
    new = incoming.select(*keys, F.struct(*attributes).alias("new"))
    pairs = old.join(new, list(keys)).where(any_changed("old", "new", attributes, null_safe))
    return pairs.select(
        *keys,
        *(F.col(f"old.{name}").alias(f"old_{name}") for name in attributes),
        *(F.col(f"new.{name}").alias(f"new_{name}") for name in attributes),
    )


def scd2_step(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    run_date: datetime.date,
    null_safe: bool = True,
    compared: Sequence[str] | None = None,
) -> DataFrame:
    """What the current versions become: open ones and those closed now, tagged in ``change``.

    Each key meets its incoming row in one full outer join and then yields one or two rows,
    so both frames are read once and shuffled once. Closed versions from earlier runs take
    no part in it. ``compared`` are the attributes whose change makes a version, all by default.
    """
    old = current.select(*keys, F.struct(*attributes, "valid_from", "valid_to").alias("old"))
    new = incoming.where(none_null(keys)).select(*keys, F.struct(*attributes).alias("new"))

    def version(
        side: str, valid_from: Column, valid_to: Column, is_current: bool, change: str
    ) -> Column:
        return F.struct(
            *keys,
            *(F.col(f"{side}.{name}").alias(name) for name in attributes),
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
            F.lit(is_current).alias("is_current"),
            F.lit(change).alias("change"),
        )

    today, never = F.lit(run_date), F.lit(None).cast("date")
    kept = version("old", F.col("old.valid_from"), F.col("old.valid_to"), True, UNCHANGED)
    closed = version("old", F.col("old.valid_from"), today, False, EXPIRED)
    opened = version("new", today, never, True, NEW_VERSION)
    added = version("new", today, never, True, NEW_KEY)

    is_new = F.col("old").isNull()
    is_changed = F.col("new").isNotNull() & any_changed("old", "new", compared or attributes, null_safe)
    rows = (
        F.when(is_new, F.array(added))
        .when(is_changed, F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    return old.join(new, list(keys), "full_outer").select(F.inline(rows))


def scd2_tagged(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    run_date: datetime.date,
    null_safe: bool = True,
    compared: Sequence[str] | None = None,
) -> DataFrame:
    """All versions after a run, with a ``change`` column that tells where each came from."""
    columns = [*keys, *attributes, *VERSION_COLUMNS, "change"]
    stepped = scd2_step(
        existing.where("is_current"), incoming, keys, attributes, run_date, null_safe, compared
    )
    history = existing.where("NOT is_current").withColumn("change", F.lit(HISTORY))
    return stepped.select(*columns).unionByName(history.select(*columns))


def scd2_apply(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    run_date: datetime.date,
    null_safe: bool = True,
) -> DataFrame:
    """All versions after a run."""
    return scd2_tagged(existing, incoming, keys, attributes, run_date, null_safe).drop("change")


def metric_columns() -> list[Column]:
    """Counts over tagged versions."""

    def tagged(*changes: str) -> Column:
        return F.count_if(F.col("change").isin(*changes))

    return [
        tagged(EXPIRED).alias("Changed"),
        tagged(NEW_KEY).alias("New"),
        tagged(UNCHANGED).alias("Unchanged"),
        tagged(HISTORY).alias("HistoryKept"),
        F.count(F.lit(1)).alias("Total"),
        F.count_if(F.col("is_current")).alias("Active"),
        F.count_if(~F.col("is_current")).alias("Historical"),
    ]


def scd2_metrics(tagged: DataFrame) -> DataFrame:
    """What a run did, counted from its own result in one pass."""
    return tagged.agg(*metric_columns())


def scd2_summary(versions: DataFrame, name: str) -> DataFrame:
    """Total, active and historical versions of a dimension."""
    counts = versions.agg(
        F.count(F.lit(1)).alias("Total"),
        F.count_if(F.col("is_current")).alias("Active"),
        F.count_if(~F.col("is_current")).alias("Historical"),
    )
    return counts.select(F.lit(name).alias("Dimension"), "Total", "Active", "Historical")
