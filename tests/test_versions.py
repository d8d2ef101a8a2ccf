"""Tables that change by commits, and the order index that is read where it is needed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import parts
from daybook.plans import kpi_parts
from daybook.plans.workspace import Workspace
from daybook.schemas import CATEGORY_KPI, CATEGORY_KPI_KEYS, LEDGER
from daybook.sinks import versions
from daybook.sinks.ledger import compact_ledger, mark_processed
from daybook.sinks.upsert import stored_kpis, upsert
from daybook.sources.tables import read_ledger, read_table
from daybook.sources.versions import read_folders, read_state
from tests.test_ledger_upsert import D6, category_rows, keys

D3 = dt.date(2025, 3, 1)

ROWS = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("m", T.StringType())])


def rows(spark, *pairs):
    return spark.createDataFrame(pairs, ROWS)


def stored(spark, path):
    return sorted(map(tuple, read_table(spark, path, ROWS).collect()), key=repr)


def test_rows_count_with_their_commit(spark, tmp_path):
    root, path, other = str(tmp_path), str(tmp_path / "a/t"), str(tmp_path / "b")
    commit = versions.Commit(spark, root)
    commit.append(path, versions.write_rows(rows(spark, (1, "x"), (2, None)), path, "v1", "m", ("k",)))
    commit.append(other, versions.write_rows(rows(spark, (3, "y")), other, "v1"))
    assert stored(spark, path) == stored(spark, other) == []
    commit.finish()
    assert stored(spark, path) == [(1, "x"), (2, None)] and stored(spark, other) == [(3, "y")]
    dead = versions.Commit(spark, root)  # never finished
    dead.append(path, versions.write_rows(rows(spark, (9, "x")), path, "v2", "m"))
    after = versions.Commit(spark, root)
    after.append(path, versions.write_rows(rows(spark, (4, "x")), path, "v3", "m"))
    after.finish()
    assert stored(spark, path) == [(1, "x"), (2, None), (4, "x")]
    moved = tmp_path.parent / f"{tmp_path.name}-moved"
    tmp_path.rename(moved)
    assert stored(spark, str(moved / "a/t")) == [(1, "x"), (2, None), (4, "x")]


def test_plain_tables_are_taken_over(spark, tmp_path):
    """Tables as earlier versions wrote them keep their rows."""
    kpis, ledger = str(tmp_path / "kpis"), str(tmp_path / "ledger")
    march, july = category_rows(spark, ("A", D3, 1)), category_rows(spark, ("A", D6, 2), ("B", D6, 3))
    plain = march.unionByName(july).withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
    plain.write.partitionBy("order_month").parquet(kpis)
    upsert(spark, category_rows(spark, ("B", D6, 9)), kpis, CATEGORY_KPI, CATEGORY_KPI_KEYS, str(tmp_path / "s"))
    found = stored_kpis(spark, kpis, CATEGORY_KPI).select("category", "order_date", F.col("daily_revenue").cast("int"))
    assert sorted(map(tuple, found.collect())) == [("A", D3, 1), ("A", D6, 2), ("B", D6, 9)]
    entries = keys(spark, "a.csv", "b.csv").withColumn("processed_at", F.current_timestamp())
    entries.select(*LEDGER.names).write.parquet(ledger)
    mark_processed(keys(spark, "c.csv"), ledger)
    assert {r.file_key for r in read_ledger(spark, ledger).collect()} == {"a.csv", "b.csv", "c.csv"}


def test_two_writers_cannot_both_win(spark, tmp_path):
    path = str(tmp_path / "t")
    base = read_state(spark, path)
    written = versions.write_rows(rows(spark, (1, "x")), path, "v1")
    versions.put_state(spark, path, base, {"": [written[""]]})
    with pytest.raises(versions.Conflict):
        versions.put_state(spark, path, base, {})
    assert stored(spark, path) == [(1, "x")]


def test_unused_folders_go_and_used_ones_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        written = versions.write_rows(rows(spark, (k, "x"), (k, "y")), path, f"v{k}", "m")
        base = read_state(spark, path)
        versions.put_state(spark, path, base, base.folders | {"x": [written["x"]]} | ({"y": [written["y"]]} if not k else {}))
    versions.write_rows(rows(spark, (7, "x")), path, "lost", "m")
    assert versions.drop_unused(spark, path, keep=1) == 5  # x of the first, y of the last, two whole versions and what nothing names
    assert stored(spark, path) == [(0, "y"), (3, "x")]


def test_a_hundred_runs_leave_few_folders(spark, tmp_path):
    sizes, most = [], 0
    for _ in range(100):
        sizes.append(1000)
        gone = versions.alike(sizes)
        if gone:
            sizes = [s for k, s in enumerate(sizes) if k not in gone] + [sum(sizes[k] for k in gone)]
        most = max(most, len(sizes))
    assert sum(sizes) == 100_000 and most <= 12
    path = str(tmp_path / "ledger")
    for k in range(9):
        mark_processed(keys(spark, f"{k}.csv"), path)
        compact_ledger(spark, path)
    assert read_ledger(spark, path).count() == 9
    assert len(read_state(spark, path).folders[""]) <= 4


def scanned_rows(df) -> int:
    """Rows that the scan of a table handed on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = [leaves.apply(k).metrics() for k in range(leaves.size())]
    return sum(m.apply("numOutputRows").value() for m in found if m.contains("numOutputRows"))


def test_a_delivery_reads_a_small_part_of_a_large_index(spark, tmp_path):
    """1,000 orders of a day and some late ones, against an index of 400,000 in several runs."""
    workspace = Workspace(str(tmp_path))
    path, part = workspace.part("days"), kpi_parts.PARTS["days"]

    def days(first, n):
        return spark.range(first, first + n).select(
            F.col("id").cast("string").alias("order_id"), F.lit("2025-07-06").cast("date").alias("order_date")
        ).withColumn("place", parts.place_of("order_id"))

    for k in range(2):
        commit = versions.Commit(spark, workspace.root)
        commit.append(path, part.write(days(200_000 * k, 200_000), path, f"v{k}"))
        commit.finish()
    late = [5, 77_777, 123_456]
    ids = days(300_500, 1000).select("order_id").union(spark.createDataFrame([(str(k),) for k in late], "order_id string"))
    near = kpi_parts.at_places(kpi_parts.stored_part(spark, workspace, "days"), ids)
    assert scanned_rows(near) < 40_000
    found = kpi_parts.known_days(spark, workspace, ids)
    assert {int(r.order_id) for r in found.collect()} == {*late, *range(300_500, 301_500)}
    unknown = spark.createDataFrame([("x-1",), ("",), ("400001",)], "order_id string")
    assert kpi_parts.known_days(spark, workspace, unknown).count() == 0


def test_places_cover_any_ids(spark):
    odd = spark.createDataFrame([(f"{k:032x}"[::-1],) for k in range(3000)] + [("",), ("ü",)], "order_id string")
    found = kpi_parts.beginnings(odd)
    places = {r[0] for r in odd.select(parts.place_of("order_id")).collect()}
    assert 1 < len(found) <= 1.1 * kpi_parts.BEGINNINGS
    assert all(any(p.startswith(b) for b in found) for p in places)
    assert kpi_parts.beginnings(odd.limit(0)) == []


def test_beginnings_are_searched_for_by_halves(spark, monkeypatch):
    """The finest that are few enough, with four counts over all ids."""
    asked = []
    count = F.approx_count_distinct
    monkeypatch.setattr(kpi_parts.F, "approx_count_distinct", lambda place: asked.append(1) or count(place))
    for n in (20_000, 2_000_000, 10):
        asked.clear()
        ids = spark.range(0, n, max(1, n // 5000)).selectExpr("cast(id + 10000000 as string) order_id")
        found = kpi_parts.beginnings(ids)
        assert len(asked) <= 4 and 1 <= len(found) <= 1.1 * kpi_parts.BEGINNINGS
        finer = [m for m in kpi_parts._COARSER if m < 12 - min(map(len, found))]
        assert not finer or ids.select(parts.place_of("order_id", finer[-1])).distinct().count() > kpi_parts.BEGINNINGS
    random = spark.range(30_000).selectExpr("cast(hex(id) as string) || repeat('x', int(id)) order_id")
    assert kpi_parts.beginnings(random.where("id < 1200")) is None and len(asked) <= 8


def test_merged_sums_are_the_same(spark, tmp_path):
    items = T.StructType.fromDDL("order_id string, product_id string, order_date date, sale_price decimal(10,2), is_returned boolean")
    some = spark.createDataFrame([("1", "a", None, None, None), ("1", "a", None, None, True), (None, "a", None, None, False)], items)
    once = parts.item_parts(some)
    twice = parts.merged_items(parts.item_parts(some.limit(1)).unionByName(parts.item_parts(some)))
    assert sorted((r.order_id or "", r.n_lines, r.returned_flag) for r in once.collect()) == [("", 1, 0), ("1", 2, 1)]
    assert {(r.order_id, r.returned_flag) for r in twice.collect()} == {("1", 1), (None, 0)}
    assert read_folders(spark, str(tmp_path), ROWS, []).count() == 0
