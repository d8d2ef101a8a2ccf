"""The shape of the plans: what is read, what is shuffled, how hot keys are split."""

import ast
import contextlib
import pathlib

import pytest
from pyspark.sql import functions as F

from daybook.operators import kpis, serving
from daybook.operators.joins import join_on_key
from daybook.plans import star
from tests.planning import executed_plan, final_tree, scans

SF = "/root/testdata/sf0.001"
PACKAGE = pathlib.Path(__file__).parent.parent / "daybook"


@contextlib.contextmanager
def settings(spark, **conf):
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Small enough that a few thousand rows count as a hot partition.
SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10000",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "8",
}


def test_category_kpis_read_five_columns_and_two(spark):
    found = scans(star.q_category_daily_kpi(spark, SF))
    schemas = sorted(scan["ReadSchema"].count(":") for scan in found)
    assert schemas == [2, 5]


def test_category_kpis_shuffle_twice_when_products_are_small(spark):
    tree = final_tree(star.q_category_daily_kpi(spark, SF))
    assert tree.count(" Exchange ") == 2
    assert "BroadcastHashJoin" in tree


def test_no_expand_for_the_distinct_counts(spark):
    plan = executed_plan(star.q_order_daily_kpi(spark, SF))
    assert "Expand" not in plan


def test_order_kpis_read_only_what_they_need(spark):
    for scan in scans(star.q_order_daily_kpi(spark, SF)):
        assert scan["ReadSchema"].count(":") <= 3


def test_a_served_range_reaches_the_scan(spark):
    """The stored table alone is read, and of it the months asked for."""
    (found,) = scans(star.q_kpi_category_range(spark, SF))
    assert "order_month" in found["PartitionFilters"]
    assert "EqualTo(category,Brand#7)" in found["PushedFilters"]
    (found,) = scans(star.q_kpi_day_range(spark, SF))
    assert "order_month" in found["PartitionFilters"]
    assert "l_orderkey" not in found["ReadSchema"]


def test_rejected_files_read_their_rows_once(spark):
    assert len(scans(star.q_rejected_files(spark, SF))) == len(scans(star.q_row_quality(spark, SF)))


def hot_items(spark, n=30_000):
    """A third of all items are of one product and one order."""
    third = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.when(third, F.lit("0")).otherwise(F.col("id").cast("string")).alias("order_id"),
        F.when(third, F.lit("p0")).otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("product_id"),
        F.lit("2025-07-06").cast("date").alias("order_date"),
        F.lit("1.25").cast("decimal(10,2)").alias("sale_price"),
        (F.col("id") % 2 == 0).alias("is_returned"),
    )


def test_a_hot_product_is_split(spark, tmp_path):
    hot_items(spark).write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    spark.range(500).select(
        F.concat(F.lit("p"), F.col("id")).alias("id"), F.concat(F.lit("c"), F.col("id") % 7).alias("category")
    ).write.parquet(str(tmp_path / "products"))
    products = spark.read.parquet(str(tmp_path / "products"))
    with settings(spark, **SMALL):
        result = kpis.category_kpis(items, products)
        assert "SortMergeJoin(skew=true)" in final_tree(result)
        total = result.agg(F.sum("daily_revenue")).first()[0]
    assert float(total) == 30_000 * 1.25


@pytest.mark.parametrize("hot", ["o5", None])
def test_a_hot_order_is_split_in_the_join_with_its_revenue(spark, tmp_path, hot):
    third = F.col("id") % 3 == 0
    spark.range(0, 30_000, 1, 8).select(
        F.when(third, F.lit(hot)).otherwise(F.concat(F.lit("o"), F.col("id"))).alias("order_id"),
        F.col("id").cast("string").alias("user_id"),
    ).write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    items = hot_items(spark).withColumn("order_id", F.concat(F.lit("o"), "order_id"))
    with settings(spark, **SMALL):
        joined = kpis.orders_with_revenue(orders, kpis.order_revenue(items))
        assert "SortMergeJoin(skew=true)" in final_tree(joined)
        assert joined.count() == 30_000
        plain = orders.join(kpis.order_revenue(items), "order_id", "left")
        assert joined.exceptAll(plain.select(*joined.columns)).count() == 0


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_joins_on_an_aggregate_are_split(spark, tmp_path, how):
    third = F.col("id") % 3 == 0
    spark.range(0, 30_000, 1, 8).select(
        F.when(third, F.lit("f")).otherwise(F.col("id").cast("string")).alias("file"), "id"
    ).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    files = rows.where("id < 20000").groupBy("file").agg(F.count("*").alias("n"))
    with settings(spark, **SMALL):
        joined = join_on_key(rows, files, "file", how)
        assert "SortMergeJoin(skew=true)" in final_tree(joined)
        assert joined.count() == rows.join(files, "file", how).count()


def test_key_types_are_brought_together(spark):
    left = spark.createDataFrame([("1",), ("2",)], "k string")
    right = spark.createDataFrame([(1, "x")], "k bigint, v string")
    assert sorted(map(tuple, join_on_key(left, right, "k", "left").collect())) == [
        ("1", "x"),
        ("2", None),
    ]


def test_order_rows_are_combined_before_they_meet_their_revenue(spark):
    """One hot order is down to a row per day before the join."""
    orders = spark.range(10_000).select(
        F.lit("o0").alias("order_id"),
        F.col("id").cast("string").alias("user_id"),
        F.expr("date_add(date'2025-07-01', cast(id % 5 as int))").alias("order_date"),
        F.lit("complete").alias("status"),
        F.lit(1).alias("num_of_item"),
    )
    items = spark.createDataFrame([("o0", 2)], "order_id string, sale_price int").withColumn(
        "sale_price", F.col("sale_price").cast("decimal(10,2)")
    )
    result = kpis.order_kpis(orders, items)
    assert [tuple(r)[1:] for r in result.collect()] == [(1, 4000, 2000, 0.0, 2000)] * 5


def test_serving_partitions_match_days(spark):
    kpi = spark.createDataFrame([], "category string, order_date date, order_month string")
    plan = executed_plan(serving.category_range(kpi, "A", "2025-07-01", "2025-08-31"))
    assert "order_month" in plan


def modules():
    """All but the optional subpackage, whose operators have rules of their own."""
    return sorted(p for p in PACKAGE.rglob("*.py") if "llm" not in p.relative_to(PACKAGE).parts)


@pytest.mark.parametrize("path", modules(), ids=lambda p: p.name)
def test_no_rows_on_the_driver_and_no_python_functions(path):
    """No collect, no pandas, no UDF and no RDD anywhere in the library."""
    banned = {
        "collect",
        "toPandas",
        "udf",
        "pandas_udf",
        "rdd",
        "localCheckpoint",
        "foreachPartition",
        "mapInPandas",
        "applyInPandas",
        "crossJoin",
    }
    used = {
        node.attr for node in ast.walk(ast.parse(path.read_text())) if isinstance(node, ast.Attribute)
    }
    assert not used & banned
