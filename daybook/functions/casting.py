"""Typing of raw text. A value that does not parse becomes NULL, never an error."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.schemas import EXACT_PRICE, MONEY, RETURNED_STATUS

# An integer, or a decimal number whose fraction is cut off; no exponent.
_WHOLE_PART = r"^\s*([+-]?\d+)(\.\d*)?\s*$"


def to_day(column) -> Column:
    """Leading date of an ISO text, or the day of a timestamp."""
    return F.try_to_date(column)


def to_count(df: DataFrame, name: str) -> Column:
    """INT from a count column: text is cut at the decimal point, numbers are cast."""
    column = F.col(name)
    if df.schema[name].dataType.typeName() == "string":
        column = F.regexp_extract(column, _WHOLE_PART, 1)
    return column.try_cast("int")


def to_money(column) -> Column:
    return F.col(column).try_cast(MONEY) if isinstance(column, str) else column.try_cast(MONEY)


def to_price(column) -> Column:
    """Price of a flat row, as exact as it is written; NULL if it does not fit.

    Rows and their rule share this expression, so no row passes the rule and
    then loses its price.
    """
    column = F.col(column) if isinstance(column, str) else column
    exact = column.try_cast(EXACT_PRICE)
    return F.when(exact == column.try_cast("decimal(38,16)"), exact)


def is_returned(status="status") -> Column:
    """Exact comparison: case and blanks matter, NULL stays NULL."""
    return F.col(status) == RETURNED_STATUS


def returned_flag(condition: Column) -> Column:
    """1 for a return, 0 for anything else including unknown."""
    return F.when(condition, 1).otherwise(0)


def month_of(day) -> Column:
    """`yyyy-MM` text, the partition value of everything stored by day."""
    return F.date_format(day, "yyyy-MM")
