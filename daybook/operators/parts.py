"""Partial sums from which the KPIs of any day follow, whatever order the rows come in.

A delivery adds rows to each table; rows of one key add up:

    items      value and return flag of an order's items of a product on a day
    orders     rows, items and returns of a customer's order on a day
    revenue    revenue of an order, at each of its days
    days       the days of each order, by order id
    waiting    revenue of orders that have no day yet, by order id

So a day's KPIs need the first three at that day and nothing else.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.casting import month_of, returned_flag
from daybook.operators.joins import join_on_key
from daybook.operators.kpis import (
    category_daily_kpi,
    customers_of_days,
    daily_kpi,
    items_with_category,
    orders_of_days,
)

#: Signs at the end of an order id that its place leaves out.
FINE = 3


def place_of(order_id: Column | str, drop: int = FINE) -> Column:
    """The length of an id and its beginning: ids in text order of this are close to the order they were given out in.

    Numbers as text are in the order of their values, in groups of a thousand.
    """
    column = F.col(order_id) if isinstance(order_id, str) else order_id
    length = F.length(column)
    kept = F.greatest(length - drop, F.lit(0))
    return F.concat(F.lpad(length.cast("string"), 4, "0"), F.substring(column, F.lit(1), kept))


def item_parts(items: DataFrame) -> DataFrame:
    summed = items.groupBy("order_id", "product_id", "order_date").agg(
        F.sum("sale_price").cast("decimal(30,2)").alias("order_value"),
        F.count("*").alias("n_lines"),
        F.max(returned_flag(F.col("is_returned"))).alias("returned_flag"),
    )
    return summed.withColumn("order_month", month_of("order_date"))


def order_parts(orders: DataFrame) -> DataFrame:
    """Rows without a day are in no KPI."""
    dated = orders.where("order_date IS NOT NULL")
    return orders_of_days(dated, "user_id").withColumn("order_month", month_of("order_date"))


def order_sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Revenue and lines of orders, added up from item parts' sums or earlier such sums."""
    return rows.groupBy("order_id", *keys).agg(
        F.sum("order_revenue").cast("decimal(30,2)").alias("order_revenue"),
        F.sum("n_lines").alias("n_lines"),
    )


def item_sums(items: DataFrame) -> DataFrame:
    """Item parts -> revenue and lines of each order that has an id."""
    named = items.where("order_id IS NOT NULL")
    return order_sums(named.withColumnRenamed("order_value", "order_revenue"))


def order_day_pairs(orders: DataFrame) -> DataFrame:
    """Order parts -> the days of each order that has an id."""
    return orders.where("order_id IS NOT NULL").select("order_id", "order_date").distinct()


def new_pairs(pairs: DataFrame, known: DataFrame) -> DataFrame:
    return pairs.join(known, ["order_id", "order_date"], "left_anti")


def with_days(sums: DataFrame, all_days: DataFrame) -> DataFrame:
    """Sums of orders at every day of their order; without a day where it has none."""
    return join_on_key(sums, all_days, "order_id", "left")


def revenue_parts(
    days_of_sums: DataFrame, known: DataFrame, fresh: DataFrame, stored: DataFrame, waiting: DataFrame
) -> DataFrame:
    """What a delivery adds to the revenue of orders at their days.

    `days_of_sums` are the sums of the new items `with_days`. They count at every
    day of their order, `known` before or `fresh`. A fresh day also gets what came
    before: the `stored` revenue of the order at its first known day, or what was
    `waiting` for an order without a day. Both are rows of their own, which add up
    like those of different deliveries. An order's stored sums are the same at all
    its days.
    """
    added = days_of_sums.where("order_date IS NOT NULL")
    first = known.groupBy("order_id").agg(F.min("order_date").alias("order_date"))
    earlier = stored.join(first, ["order_id", "order_date"], "left_semi").drop("order_date")
    unseen = join_on_key(waiting, known.select("order_id"), "order_id", "left_anti")
    before = order_sums(earlier.unionByName(unseen))
    caught_up = join_on_key(fresh, before, "order_id", "inner")
    return added.unionByName(caught_up).withColumn("order_month", month_of("order_date"))


def still_waiting(days_of_sums: DataFrame) -> DataFrame:
    """Sums of orders that have no day."""
    missing = days_of_sums.where("order_date IS NULL").drop("order_date")
    return missing.withColumn("place", place_of("order_id"))


def merged_items(parts: DataFrame) -> DataFrame:
    return parts.groupBy("order_id", "product_id", "order_date", "order_month").agg(
        F.sum("order_value").cast("decimal(30,2)").alias("order_value"),
        F.sum("n_lines").alias("n_lines"),
        F.max("returned_flag").alias("returned_flag"),
    )


def _counts() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n_rows", "n_items", "n_returned")]


def merged_orders(parts: DataFrame) -> DataFrame:
    return parts.groupBy("order_id", "user_id", "order_date", "order_month").agg(*_counts())


def merged_revenue(parts: DataFrame) -> DataFrame:
    return order_sums(parts, "order_date", "order_month")


def merged_waiting(parts: DataFrame) -> DataFrame:
    return order_sums(parts, "place")


def category_kpis_of_parts(items: DataFrame, products: DataFrame) -> DataFrame:
    """Item parts of whole days and products -> category KPIs of these days."""
    values = (
        items_with_category(items, products)
        .groupBy("order_id", "category", "order_date")
        .agg(F.sum("order_value").alias("order_value"), F.max("returned_flag").alias("returned_flag"))
    )
    return category_daily_kpi(values)


def order_kpis_of_parts(orders: DataFrame, revenue: DataFrame) -> DataFrame:
    """Parts of whole days -> order KPIs of these days.

    Rows of an order and its revenue meet in one aggregate, without a join. Revenue
    at a day without order rows is left out; orders without an id have none.
    """
    counts = orders.select("order_id", "order_date", "n_rows", "n_items", "n_returned")
    by_order = (
        counts.unionByName(revenue.select("order_id", "order_date", "order_revenue"), allowMissingColumns=True)
        .groupBy("order_id", "order_date")
        .agg(*_counts(), F.sum("order_revenue").cast("decimal(30,2)").alias("order_revenue"))
    )
    return daily_kpi(by_order.where("n_rows IS NOT NULL"), customers_of_days(orders))
