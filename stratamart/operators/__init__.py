"""Transformations from DataFrame to DataFrame. None of them runs a job or writes anything."""

from .conform import conform, judge, quarantine, type_rows, with_date_text
from .dimensions import date_dimension, dimension, one_row_per_key, rejected_keys
from .facts import sales_fact, with_year_month
from .histories import scd2_from_history, scd_mixed_apply
from .point_in_time import as_of_carry_forward, as_of_join
from .surrogate import with_surrogate_key
from .upserts import scd1_upsert
from .versions import (
    scd2_apply,
    scd2_bootstrap,
    scd2_changed,
    scd2_metrics,
    scd2_summary,
    scd2_tagged,
)

__all__ = [
    "as_of_carry_forward",
    "as_of_join",
    "conform",
    "date_dimension",
    "dimension",
    "judge",
    "one_row_per_key",
    "quarantine",
    "rejected_keys",
    "sales_fact",
    "scd1_upsert",
    "scd2_apply",
    "scd2_bootstrap",
    "scd2_changed",
    "scd2_from_history",
    "scd2_metrics",
    "scd2_summary",
    "scd2_tagged",
    "scd_mixed_apply",
    "type_rows",
    "with_date_text",
    "with_surrogate_key",
    "with_year_month",
]
