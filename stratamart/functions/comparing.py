"""Predicates over several columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_changed(old: str, new: str, attributes: Sequence[str], null_safe: bool = True) -> Column:
    """True where any attribute differs between the two named structs.

    With ``null_safe=False`` a comparison with null is unknown, so a change from or to
    null alone goes unnoticed.
    """

    def differs(name: str) -> Column:
        before, after = F.col(f"{old}.{name}"), F.col(f"{new}.{name}")
        return ~before.eqNullSafe(after) if null_safe else before != after

    return F.coalesce(reduce(or_, map(differs, attributes)), F.lit(False))


def none_null(names: Sequence[str]) -> Column:
    return reduce(and_, (F.col(name).isNotNull() for name in names))
