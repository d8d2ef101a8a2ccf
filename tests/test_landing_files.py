"""The CSV files that queries land."""

import os

from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from daybook.plans import star
from daybook.plans.workspace import Workspace
from daybook.sources.tables import small_rows


def tables(spark, folder) -> str:
    orders = [(k, k % 3, "O", f"2025-07-0{1 + k % 2} 00:00:00", "5-LOW") for k in range(20)]
    lines = [(k % 20, k % 4, float(k), "N", f"2025-07-0{1 + k % 2} 00:00:00") for k in range(50)]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate string, o_orderpriority string"
    made = spark.createDataFrame(orders, schema).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    made.write.parquet(f"{folder}/orders.parquet")
    schema = "l_orderkey bigint, l_partkey bigint, l_extendedprice double, l_returnflag string, l_shipdate string"
    made = spark.createDataFrame(lines, schema).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    made.write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def csv_files(folder) -> list[str]:
    return sorted(f"{at}/{n}" for at, _, names in os.walk(folder) for n in names if n.endswith(".csv"))


def test_one_file_is_not_made_by_one_task_that_reads_the_tables(spark, tmp_path, monkeypatch):
    folder, workspace = tables(spark, tmp_path / "in"), Workspace(str(tmp_path / "shop"))

    def refuse(self, n):
        raise AssertionError("coalesce runs the scans and joins before it in as few tasks")

    monkeypatch.setattr(DataFrame, "coalesce", refuse)
    star.land(spark, folder, workspace, F.col("o_orderkey") % 2 == 0, "last", files=1)
    for file_type, n in (("orders", 10), ("order_items", 25)):
        (file,) = csv_files(workspace.incoming(file_type))
        assert len(open(file).readlines()) == 1 + n


def test_csv_files_are_written_where_the_rows_are(spark, tmp_path):
    rows = spark.range(0, 40, 1, 4).where("id >= 10").selectExpr("cast(id as string) order_id", "'x' status")
    star._write_csv(rows, str(tmp_path / "headed"))
    assert [len(open(f).readlines()) for f in csv_files(tmp_path / "headed")] == [11, 11, 11]
    star._write_csv(rows, str(tmp_path / "bare"), header=False)
    assert [len(open(f).readlines()) for f in csv_files(tmp_path / "bare")] == [10, 10, 10]


def test_no_rows_leave_one_file_with_a_header(spark, tmp_path):
    star._write_csv(spark.range(0, 40, 1, 4).where("id < 0").selectExpr("id order_id"), str(tmp_path / "none"))
    assert [open(f).read() for f in csv_files(tmp_path / "none")] == ["order_id\n"]


def test_rows_for_the_driver_leave_their_scan_to_many_tasks(spark, monkeypatch):
    def refuse(self, n):
        raise AssertionError("coalesce runs the scan before it in one task")

    monkeypatch.setattr(DataFrame, "coalesce", refuse)
    listed = spark.range(0, 40, 1, 8).selectExpr("id", "cast(40 - id as string) path")
    assert sorted(row.id for row in small_rows(listed)) == list(range(40))
    assert [row.path for row in small_rows(listed, "path")] == sorted(str(40 - k) for k in range(40))


def delivered(spark, workspace, name) -> list[list[str]]:
    return [
        sorted(r.value for r in spark.read.text(f"{workspace.incoming(t)}/{name}").where("value NOT LIKE 'order_id,%'").collect())
        for t in ("orders", "order_items")
    ]


def test_two_deliveries_read_the_tables_once(spark, tmp_path, monkeypatch):
    """Order 1 is in both, order 3 has no day, order 4 no lines, and the lines of 9 no order."""
    folder, workspace = str(tmp_path / "in"), Workspace(str(tmp_path / "shop"))
    days = [(1, "1998-06-30"), (1, "1998-07-01"), (2, "1998-07-02"), (3, None), (4, "1998-01-01"), (4, "1998-01-01")]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate string"
    made = spark.createDataFrame([(k, 7, "O", day) for k, day in days], schema)
    made.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")).write.parquet(f"{folder}/orders.parquet")
    schema = "l_orderkey bigint, l_partkey bigint, l_extendedprice double, l_returnflag string, l_shipdate timestamp"
    lines = [(k, 5, 1.5, "N", None) for k in (1, 1, 2, 3, 9, None)]
    spark.createDataFrame(lines, schema).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(5, "b")], "p_partkey bigint, p_brand string").write.parquet(f"{folder}/part.parquet")

    star.deliver(spark, folder, workspace, first=True)
    assert not os.path.exists(f"{workspace.incoming('orders')}/second")
    monkeypatch.setattr(star, "table", None)
    star.deliver(spark, folder, workspace, first=False)
    orders, items = delivered(spark, workspace, "first")
    assert [row.split(",")[0] + row[-2:] for row in orders] == ["1,2", "4,0", "4,0"]
    assert items == ["1,5,,1.50,N"] * 2
    orders, items = delivered(spark, workspace, "second")
    assert [row.split(",")[0] + row[-2:] for row in orders] == ["1,2", "2,1"]
    assert items == ["1,5,,1.50,N"] * 2 + ["2,5,,1.50,N"]


def test_a_delivery_without_orders_leaves_headers(spark, tmp_path):
    folder, workspace = tables(spark, tmp_path / "in"), Workspace(str(tmp_path / "shop"))
    spark.createDataFrame([(5, "b")], "p_partkey bigint, p_brand string").write.parquet(f"{folder}/part.parquet")
    for first, n in ((True, 0), (False, 20)):  # all orders are of 2025
        star.deliver(spark, folder, workspace, first)
        files = csv_files(f"{workspace.incoming('orders')}/{'first' if first else 'second'}")
        assert files and sum(len(open(f).readlines()) - 1 for f in files) == n
