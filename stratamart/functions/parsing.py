"""Text to typed values. Text that cannot be read becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two date patterns of the feed.
YEAR_FIRST = "yyyy-MM-dd"
DAY_FIRST = "dd-MM-yyyy"
PLAIN_YEAR_FIRST = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
PLAIN_DAY_FIRST = r"^[0-9]{2}-[0-9]{2}-(?!0000)[0-9]{4}\z"


# What a cast to an integer type accepts, except for the range: padding, a sign, digits.
WHOLE_NUMBER = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"


def whole_number(name: str, kind: str = "int") -> Column:
    """The number, or null for other text.

    A cast that fails raises and catches an error for each row, which takes as long as
    parsing a hundred numbers; the pattern keeps columns with much unreadable text cheap.
    """
    text = F.col(name)
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast(kind)).alias(name)


def decimal_number(name: str) -> Column:
    return F.col(name).try_cast("double").alias(name)


def order_date(name: str) -> Column:
    """The date in either pattern; the third character tells which one can match at all.

    Dates of exactly four, two and two digits are cast, which takes a fraction of the time that a
    pattern does. All others are left to the pattern, also those of the year 0, which only a cast knows.
    """
    text = F.col(name)
    is_day_first = F.substring(text, 3, 1) == "-"
    turned = F.concat(F.substring(text, 7, 4), F.substring(text, 3, 4), F.substring(text, 1, 2))
    parsed = (
        F.when(text.rlike(PLAIN_DAY_FIRST), turned.try_cast("date"))
        .when(text.rlike(PLAIN_YEAR_FIRST), text.try_cast("date"))
        .when(is_day_first, F.try_to_date(text, DAY_FIRST))
        .otherwise(F.try_to_date(text, YEAR_FIRST))
    )
    return parsed.alias(name)
