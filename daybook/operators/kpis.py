"""KPIs by category and day, and KPIs over all orders of a day.

Every aggregate here combines partial results before it shuffles, so one order,
product, customer, category or day may hold any share of the rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.casting import returned_flag
from daybook.operators.joins import join_on_key
from daybook.schemas import RETURNED_STATUS, TOTAL


def items_with_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Inner join of items with the category of their product.

    Items without a known product drop out and a repeated product id repeats its
    items. No broadcast hint: Spark broadcasts the two product columns while
    they are below `spark.sql.autoBroadcastJoinThreshold`. Beyond that both
    sides are shuffled straight from their scans, the shape in which adaptive
    execution splits a product that holds too many items.
    """
    category = products.select(F.col("id").alias("_product"), "category")
    return items.drop("category").join(category, F.col("product_id") == F.col("_product")).drop("_product")


def category_order_values(items: DataFrame) -> DataFrame:
    """Value of each order within a category on a day, and whether any item came back."""
    return items.groupBy("order_id", "category", "order_date").agg(
        F.sum("sale_price").alias("order_value"),
        F.max(returned_flag(F.col("is_returned"))).alias("returned_flag"),
    )


def _mean(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n)


def category_daily_kpi(order_values: DataFrame) -> DataFrame:
    return (
        order_values.groupBy("category", "order_date")
        .agg(
            F.sum("order_value").alias("_value"),
            F.count("order_value").alias("_orders"),
            F.avg(F.col("returned_flag").cast("double")).alias("avg_return_rate"),
        )
        .select(
            "category",
            "order_date",
            F.col("_value").try_cast(TOTAL).alias("daily_revenue"),
            _mean(F.col("_value"), F.col("_orders")).alias("avg_order_value"),
            "avg_return_rate",
        )
    )


def category_kpis(items: DataFrame, products: DataFrame) -> DataFrame:
    """Cleaned items and products -> category KPIs."""
    return category_daily_kpi(category_order_values(items_with_category(items, products)))


def order_revenue(items: DataFrame) -> DataFrame:
    """Revenue and number of lines of each order."""
    return items.groupBy("order_id").agg(
        F.sum("sale_price").alias("order_revenue"),
        F.count("*").alias("n_lines"),
    )


def orders_with_revenue(orders: DataFrame, revenue: DataFrame) -> DataFrame:
    """Left join of order rows with the revenue of their order.

    Order ids may repeat or be missing in any number: the join splits them.
    """
    return join_on_key(orders, revenue, "order_id", "left")


def order_daily_kpi(orders: DataFrame, revenue: DataFrame, count_lines: bool = False) -> DataFrame:
    """Cleaned orders and the revenue per order -> KPIs of each day.

    Order rows are first brought down to one per order and day. That makes the
    distinct order count a plain count, leaves at most one row per day of any
    order for the join with its revenue, and keeps the weight of repeated order
    rows in `n_rows`. Distinct customers are counted from their own two columns.
    Both parts meet in one last aggregate by day, with no join between them.

    With `count_lines` the items sold are the order's lines instead of the
    order's own `num_of_item`, for sources that have no such column.
    """
    by_order = orders_of_days(orders, count_lines=count_lines)
    valued = by_order.join(revenue, "order_id", "left")
    if count_lines:
        lines = F.coalesce(F.col("n_lines"), F.lit(0).cast("bigint"))
        valued = valued.withColumn("n_items", F.col("n_rows") * lines)
    return daily_kpi(valued, customers_of_days(orders))


def orders_of_days(orders: DataFrame, *more: str, count_lines: bool = False) -> DataFrame:
    """One row per order and day, and per value of further columns. Counts of several such tables add up."""
    items = F.lit(None).cast("bigint") if count_lines else F.sum("num_of_item")
    return orders.groupBy("order_id", "order_date", *more).agg(
        F.count("*").alias("n_rows"),
        items.alias("n_items"),
        F.sum(returned_flag(F.col("status") == RETURNED_STATUS)).alias("n_returned"),
    )


def customers_of_days(orders: DataFrame) -> DataFrame:
    return orders.select("order_date", "user_id").distinct()


def daily_kpi(valued: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of days with `order_revenue`, and customers of days -> KPIs of each day."""
    order_part = valued.select(
        "order_date",
        F.col("order_id").isNotNull().cast("bigint").alias("_orders"),
        F.lit(0).cast("bigint").alias("_customers"),
        # Only a repeated order row needs the wide product.
        F.when(F.col("n_rows") == 1, F.col("order_revenue").cast("decimal(38,2)"))
        .otherwise(F.col("order_revenue").cast("decimal(38,2)") * F.col("n_rows"))
        .cast("decimal(38,2)")
        .alias("_revenue"),
        F.col("n_items").alias("_items"),
        F.col("n_returned").alias("_returned"),
        F.col("n_rows").alias("_rows"),
    )
    customer_part = customers.select(
        "order_date",
        F.lit(0).cast("bigint").alias("_orders"),
        F.col("user_id").isNotNull().cast("bigint").alias("_customers"),
        F.lit(None).cast("decimal(38,2)").alias("_revenue"),
        F.lit(None).cast("bigint").alias("_items"),
        F.lit(0).cast("bigint").alias("_returned"),
        F.lit(0).cast("bigint").alias("_rows"),
    )
    return (
        order_part.unionByName(customer_part)
        .groupBy("order_date")
        .agg(
            F.sum("_orders").alias("total_orders"),
            F.sum("_revenue").try_cast(TOTAL).alias("total_revenue"),
            F.sum("_items").alias("total_items_sold"),
            F.sum("_returned").alias("_returned"),
            F.sum("_rows").alias("_rows"),
            F.sum("_customers").alias("unique_customers"),
        )
        .select(
            "order_date",
            "total_orders",
            "total_revenue",
            "total_items_sold",
            _mean(F.col("_returned"), F.col("_rows")).alias("return_rate"),
            "unique_customers",
        )
    )


def order_kpis(orders: DataFrame, items: DataFrame, count_lines: bool = False) -> DataFrame:
    """Cleaned orders and items -> order KPIs."""
    return order_daily_kpi(orders, order_revenue(items), count_lines)


def reconciliation(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items and revenue that miss from the category KPIs for want of a known product."""
    known = products.select(F.col("id").alias("product_id"))
    return (
        items.join(known, "product_id", "left_anti")
        .agg(
            F.count("*").alias("items_without_product"),
            F.sum("sale_price").try_cast(TOTAL).alias("revenue_without_product"),
        )
    )
