"""Aggregate expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are added in millionths; those of a size that a bigint cannot hold are refused.
MILLION = 1_000_000
TOO_LARGE = 1e15


def is_amount(name: str) -> Column:
    """Whether a number can be added up: finite and of a realistic size. True of null."""
    value = F.col(name)
    return value.isNull() | (F.abs(value) < TOO_LARGE)


def exact_sum(name: str) -> Column:
    """Sum of a double column of amounts that is the same for every row order.

    Adding doubles rounds at each step, so the last digits of a distributed sum depend on
    which task finishes first, and a sum that is rounded afterwards can flip by a whole
    unit between two runs. Every amount is therefore taken to its nearest millionth and added
    in two whole numbers, the units and the millionths, neither of which a realistic number
    of rows overflows. That costs hardly more than adding doubles, whereas decimals cost
    several times as much. An amount that is not finite or not below 1e15 is an error that
    names it.
    """
    units, rest = amount_parts(name)
    return joined_amount(F.sum(units), F.sum(rest))


def amount_parts(name: str) -> tuple[Column, Column]:
    """An amount as whole units and whole millionths, which can be added and taken away exactly."""
    value = F.col(name)
    problem = F.concat(F.lit(f"{name} is not an amount: "), value.cast("string"))
    amount = F.when(is_amount(name), value).otherwise(F.raise_error(problem).cast("double"))
    units = F.floor(amount)
    return units, F.rint((amount - units) * MILLION).cast("bigint")


def joined_amount(units: Column, rest: Column) -> Column:
    """The amount of which these are the sums of the parts."""
    high, low = (part.cast("decimal(19,0)") for part in (units, rest))
    total = (high * F.lit(Decimal(MILLION)) + low) * F.lit(Decimal(1) / MILLION)
    return total.cast("double")
