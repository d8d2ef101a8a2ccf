"""Typing of raw orders and order items."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.casting import is_returned, to_count, to_day, to_money
from daybook.functions.labels import labels_where


def _rejects(typed: dict[str, Column]) -> Column:
    """Names of the columns that hold a value which could not be typed."""
    return labels_where(
        (raw, F.col(raw).isNotNull() & value.isNull()) for raw, value in typed.items()
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """Add `order_date`, type `num_of_item` where there is one, list the rejects."""
    day = to_day("created_at")
    columns = {"order_date": day}
    typed = {"created_at": day}
    if "num_of_item" in raw.columns:
        count = to_count(raw, "num_of_item")
        columns["num_of_item"] = count
        typed["num_of_item"] = count
    return raw.withColumns({**columns, "rejects": _rejects(typed)})


def clean_items(raw: DataFrame) -> DataFrame:
    """Add `order_date` and `is_returned`, type `sale_price`, list the rejects."""
    day = to_day("created_at")
    price = to_money("sale_price")
    return raw.withColumns(
        {
            "order_date": day,
            "sale_price": price,
            "is_returned": is_returned("status"),
            "rejects": _rejects({"created_at": day, "sale_price": price}),
        }
    )


CLEAN = {"orders": clean_orders, "order_items": clean_items}


def reject_counts(cleaned: DataFrame) -> DataFrame:
    """Rows per column whose value could not be typed.

    The outer form keeps Spark from computing every list twice, once to drop the
    empty ones.
    """
    return (
        cleaned.select(F.explode_outer("rejects").alias("column_name"))
        .where("column_name IS NOT NULL")
        .groupBy("column_name")
        .agg(F.count("*").alias("rejected"))
    )
