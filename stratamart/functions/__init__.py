"""Column expressions shared by the operators; all of them run inside the JVM."""

from .aggregates import exact_sum, is_amount
from .comparing import any_changed, none_null
from .parsing import WHOLE_NUMBER, decimal_number, order_date, whole_number

__all__ = [
    "WHOLE_NUMBER",
    "any_changed",
    "decimal_number",
    "exact_sum",
    "is_amount",
    "none_null",
    "order_date",
    "whole_number",
]
