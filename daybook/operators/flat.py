"""The flat variant: one file of order rows that carry their own category and price."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.casting import returned_flag, to_count, to_price
from daybook.schemas import TOTAL


def clean_flat(raw: DataFrame) -> DataFrame:
    """Type the raw text columns; `returned` is true in any letter case."""
    return raw.withColumns(
        {
            "order_date": F.try_to_date("order_date", "yyyy-MM-dd")
            if raw.schema["order_date"].dataType.typeName() == "string"
            else F.col("order_date").cast("date"),
            "quantity": to_count(raw, "quantity"),
            "unit_price": to_price("unit_price"),
            "returned": F.lower(F.col("returned").cast("string")) == "true",
        }
    )


def with_revenue(flat: DataFrame) -> DataFrame:
    """Exact revenue of a row; only sums are rounded to cents."""
    return flat.withColumn("revenue", F.col("quantity") * F.col("unit_price"))


def flat_category_kpi(flat: DataFrame) -> DataFrame:
    """Each row is one order: revenue, mean row value and share of returned rows."""
    return (
        with_revenue(flat)
        .groupBy("category", "order_date")
        .agg(
            F.sum("revenue").alias("_revenue"),
            F.count("*").alias("_orders"),
            F.sum(returned_flag(F.col("returned"))).alias("_returned"),
        )
        .select(
            "category",
            "order_date",
            F.col("_revenue").try_cast(TOTAL).alias("daily_revenue"),
            (F.col("_revenue").cast("double") / F.col("_orders")).alias("avg_order_value"),
            (F.col("_returned").cast("double") / F.col("_orders")).alias("avg_return_rate"),
        )
    )


def flat_daily_kpi(flat: DataFrame) -> DataFrame:
    return (
        with_revenue(flat)
        .groupBy("order_date")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("revenue").try_cast(TOTAL).alias("total_revenue"),
            F.sum("quantity").alias("total_items_sold"),
            F.avg(returned_flag(F.col("returned")).cast("double")).alias("return_rate"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
    )
