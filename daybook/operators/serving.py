"""Look-ups and dashboard queries on the KPI tables."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.casting import month_of
from daybook.schemas import CATEGORY_KPI_KEYS

Day = dt.date | str


def _days(kpis: DataFrame, first: Day, last: Day) -> Column:
    """Day range, with the matching partition range on a stored table."""
    first, last = F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")
    days = F.col("order_date").between(first, last)
    if "order_month" in kpis.columns:
        days = days & F.col("order_month").between(month_of(first), month_of(last))
    return days


def category_range(kpis: DataFrame, category: str, first: Day, last: Day) -> DataFrame:
    """KPIs of one category from `first` to `last`, both included."""
    return kpis.where(_days(kpis, first, last) & (F.col("category") == category)).drop("order_month")


def category_day(kpis: DataFrame, category: str, day: Day) -> DataFrame:
    return category_range(kpis, category, day, day)


def day_range(kpis: DataFrame, first: Day, last: Day) -> DataFrame:
    """Order KPIs from `first` to `last`, both included."""
    return kpis.where(_days(kpis, first, last)).drop("order_month")


def revenue_by_category(category_kpis: DataFrame) -> DataFrame:
    return category_kpis.groupBy(CATEGORY_KPI_KEYS[0]).agg(F.sum("daily_revenue").alias("revenue"))


def trend(order_kpis: DataFrame) -> DataFrame:
    """Revenue and return rate over time."""
    return order_kpis.select("order_date", "total_revenue", "return_rate").orderBy("order_date")


def headline_totals(order_kpis: DataFrame, orders: DataFrame) -> DataFrame:
    """Total orders of all days, and customers counted once over all days.

    Daily customer counts do not add up, so customers come from the orders.
    """
    totals = order_kpis.agg(
        F.sum("total_orders").alias("total_orders"), F.lit(0).cast("bigint").alias("customers")
    )
    customers = orders.agg(
        F.lit(0).cast("bigint").alias("total_orders"),
        F.countDistinct("user_id").alias("customers"),
    )
    return totals.unionByName(customers).agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("customers").alias("unique_customers"),
    )
