"""Histories built at once, and dimensions of which only some attributes have one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import none_null
from ..schemas import VERSION_COLUMNS
from .versions import scd2_tagged


def _same(names: Sequence[str], left: str, right: str) -> Column:
    return reduce(and_, (F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in names))


def scd2_from_history(
    feed: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    date_column: str,
    existing: DataFrame | None = None,
) -> DataFrame:
    """All versions that a dated feed leads to, for all of its days at once.

    The result is that of applying its days one by one: a version begins on the first day of
    each run of days with equal attributes and ends when the next one begins; days on which a key
    does not come in change nothing. Attributes are compared null-safe. Of several rows of a
    key and day those with the greatest attributes count; rows without key or day are left out.

    ``existing`` versions are carried on: their closed ones stay, and a key's days on or before the
    ``valid_from`` of its current version are in the past and left out.

    Rows are reduced to one per key and day before they are sorted, so a key that holds most of
    the feed is as many rows as there are days.
    """
    dated = feed.where(none_null([*keys, date_column])).select(
        *keys, F.col(date_column).cast("date").alias("valid_from"), F.struct(*attributes).alias("now")
    )
    daily = dated.groupBy(*keys, "valid_from").agg(F.max("now").alias("now"))
    closed = None
    if existing is not None:
        current = existing.where("is_current").select(*keys, "valid_from", F.struct(*attributes).alias("now"))
        closed = existing.where("NOT is_current").select(*keys, *attributes, *VERSION_COLUMNS)
        daily = daily.withColumn("known", F.lit(False)).unionByName(current.withColumn("known", F.lit(True)))
        whole = Window.partitionBy(*keys)
        start = F.max(F.when(F.col("known"), F.col("valid_from"))).over(whole)
        daily = daily.withColumn("start", start)
        daily = daily.where(F.col("start").isNull() | F.col("known") | (F.col("valid_from") > F.col("start")))
    in_order = Window.partitionBy(*keys).orderBy("valid_from")
    changes = daily.withColumn("before", F.lag("now").over(in_order)).where(
        F.col("before").isNull() | ~_same(attributes, "before", "now")
    )
    versions = changes.withColumn("valid_to", F.lead("valid_from").over(in_order)).select(
        *keys, "now.*", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current")
    )
    return versions if closed is None else versions.unionByName(closed)


def scd_mixed_apply(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    corrected: Sequence[str],
    tracked: Sequence[str],
    run_date,
) -> DataFrame:
    """All versions after a run, of a dimension whose attributes follow two policies.

    A change of a ``tracked`` attribute (type 2) closes the version in force and opens another.
    A ``corrected`` one (type 1) has no history: the incoming value, null included, takes the place
    of what every version of the key had, closed ones too. Versions of a key that came in, follow
    each other without a gap and are then equal become one, so a table that used to track an
    attribute loses the versions that only this one had made. Keys that do not come in stay as they
    are; both frames are as for ``scd2_apply``.
    """
    attributes = [*corrected, *tracked]
    stepped = scd2_tagged(existing, incoming, keys, attributes, run_date, compared=tracked).drop("change")
    new = incoming.where(none_null(keys)).select(*keys, F.struct(*corrected).alias("fixed"), F.lit(True).alias("came_in"))
    valued = stepped.join(new, list(keys), "left")
    fixed = {name: F.when(F.col("came_in"), F.col(f"fixed.{name}")).otherwise(F.col(name)) for name in corrected}
    rows = valued.withColumns({**fixed, "came_in": F.coalesce("came_in", F.lit(False))})
    return _merged(rows, keys, attributes).select(*keys, *attributes, *VERSION_COLUMNS)


def _merged(rows: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Versions of keys that came in, equal neighbours made one; a key has as many as it had changes."""
    in_order = Window.partitionBy(*keys).orderBy("valid_from", F.col("valid_to").asc_nulls_last())
    one = F.struct(*attributes)
    rows = rows.withColumns({"own": one, "before": F.lag(one).over(in_order), "ended": F.lag("valid_to").over(in_order)})
    goes_on = F.col("came_in") & F.col("before").isNotNull() & (F.col("ended") == F.col("valid_from"))
    begins = F.when(F.coalesce(goes_on, F.lit(False)) & _same(attributes, "before", "own"), 0).otherwise(1)
    rows = rows.withColumn("run", F.sum(begins).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = rows.groupBy(*keys, "run").agg(
        F.min(F.struct("valid_from", "own")).alias("first"),
        F.when(F.max("is_current"), F.lit(None)).otherwise(F.max("valid_to")).alias("valid_to"),
        F.max("is_current").alias("is_current"),
    )
    return merged.select(*keys, "first.own.*", "first.valid_from", "valid_to", "is_current")
