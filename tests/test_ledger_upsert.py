import datetime as dt
from decimal import Decimal

import pytest

from daybook.operators.ledger import latest_file_per_type, latest_files, new_files
from daybook.operators.merge import merge_by_key
from daybook.schemas import CATEGORY_KPI, CATEGORY_KPI_KEYS, ORDER_KPI, ORDER_KPI_KEYS
from daybook.sinks.ledger import mark_processed
from daybook.sinks.upsert import stored_kpis, upsert
from daybook.sources.tables import read_ledger
from daybook.sources.versions import read_state
from tests.conftest import as_rows

D6, D7 = dt.date(2025, 7, 6), dt.date(2025, 7, 7)
D6_NOON = dt.datetime(2025, 7, 6, 12)


def keys(spark, *names):
    rows = [(n, "orders", f"file:/in/{n}", D6_NOON) for n in names]
    return spark.createDataFrame(rows, "file_key string, file_type string, path string, modified_at timestamp")


def test_known_files_are_not_new(spark, tmp_path):
    path = str(tmp_path / "ledger")
    listed = keys(spark, "validated/a.csv", "validated/b.csv", "validated/c.csv", "validated/n.txt")
    mark_processed(keys(spark, "validated/b.csv"), path)
    fresh = new_files(listed, read_ledger(spark, path))
    assert as_rows(fresh, "file_key") == [("validated/a.csv",), ("validated/c.csv",)]
    mark_processed(fresh, path)
    assert new_files(listed, read_ledger(spark, path)).count() == 0


def test_a_file_is_its_path_and_time(spark, tmp_path):
    """Equal keys in two folders are two files, and so is a file that lands again."""
    path = str(tmp_path / "ledger")
    schema = "file_key string, file_type string, path string, modified_at timestamp"
    later = dt.datetime(2025, 7, 7)
    rows = [("v/x.csv", "orders", p, t) for p, t in (("a/x.csv", D6_NOON), ("b/x.csv", D6_NOON), ("a/x.csv", later))]
    mark_processed(spark.createDataFrame(rows[:1], schema), path)
    fresh = new_files(spark.createDataFrame(rows, schema), read_ledger(spark, path))
    assert as_rows(fresh, "path", "modified_at") == [("a/x.csv", later), ("b/x.csv", D6_NOON)]
    assert as_rows(latest_files(fresh), "path", "modified_at") == [("a/x.csv", later)]


def test_ledger_keeps_the_last_time(spark, tmp_path):
    path = str(tmp_path / "ledger")
    for hour in (9, 11, 10):
        mark_processed(keys(spark, "a.csv"), path, dt.datetime(2025, 7, 6, hour))
    assert as_rows(read_ledger(spark, path), "file_key", "processed_at") == [
        ("a.csv", dt.datetime(2025, 7, 6, 11))
    ]


def test_no_ledger_yet(spark, tmp_path):
    assert read_ledger(spark, str(tmp_path / "none")).count() == 0


def test_latest_is_last_in_text_order(spark):
    files = keys(spark, "v/orders/dt=2025-07-06/z.csv", "v/orders/dt=2025-07-07/a.csv")
    assert as_rows(latest_file_per_type(files), "latest_key", "pending") == [
        ("v/orders/dt=2025-07-07/a.csv", 2)
    ]


def category_rows(spark, *rows):
    full = [(c, d, Decimal(v), float(v), 0.0) for c, d, v in rows]
    return spark.createDataFrame(full, CATEGORY_KPI)


def test_category_upsert(spark, tmp_path):
    target = str(tmp_path / "kpis")
    stored = category_rows(spark, ("A", D6, 1), ("B", D6, 2), ("A", D7, 3))
    upsert(spark, stored, target, CATEGORY_KPI, CATEGORY_KPI_KEYS, str(tmp_path / "s1"))
    for step in ("s2", "s3"):
        new = category_rows(spark, ("B", D6, 9))
        upsert(spark, new, target, CATEGORY_KPI, CATEGORY_KPI_KEYS, str(tmp_path / step))
        found = stored_kpis(spark, target, CATEGORY_KPI)
        assert as_rows(found, "category", "order_date", "daily_revenue") == [
            ("A", D6, Decimal("1.00")),
            ("A", D7, Decimal("3.00")),
            ("B", D6, Decimal("9.00")),
        ]


def test_upsert_leaves_other_months_alone(spark, tmp_path):
    target = tmp_path / "kpis"
    march = dt.date(2025, 3, 1)
    first = category_rows(spark, ("A", march, 1), ("A", D6, 2))
    upsert(spark, first, str(target), CATEGORY_KPI, CATEGORY_KPI_KEYS, str(tmp_path / "s1"))
    before = read_state(spark, str(target)).folders
    new = category_rows(spark, ("A", D6, 5))
    upsert(spark, new, str(target), CATEGORY_KPI, CATEGORY_KPI_KEYS, str(tmp_path / "s2"))
    after = read_state(spark, str(target)).folders
    assert after["2025-03"] == before["2025-03"] and after["2025-07"] != before["2025-07"]
    assert as_rows(stored_kpis(spark, str(target), CATEGORY_KPI), "order_date", "daily_revenue") == [
        (march, Decimal("1.00")),
        (D6, Decimal("5.00")),
    ]


def test_rows_without_a_key_are_not_stored(spark, tmp_path):
    target = str(tmp_path / "kpis")
    rows = category_rows(spark, ("A", D6, 1), (None, D6, 2), ("B", None, 3))
    upsert(spark, rows, target, CATEGORY_KPI, CATEGORY_KPI_KEYS, str(tmp_path / "s"))
    assert as_rows(stored_kpis(spark, target, CATEGORY_KPI), "category") == [("A",)]


def test_upsert_of_nothing(spark, tmp_path):
    target = str(tmp_path / "kpis")
    empty = spark.createDataFrame([], ORDER_KPI)
    upsert(spark, empty, target, ORDER_KPI, ORDER_KPI_KEYS, str(tmp_path / "s"))
    assert stored_kpis(spark, target, ORDER_KPI).count() == 0


def test_a_whole_row_is_replaced(spark):
    stored = spark.createDataFrame([(D6, 1, 5), (D7, 2, 6)], "order_date date, a int, b int")
    new = spark.createDataFrame([(D6, 9, None)], "order_date date, a int, b int")
    merged = merge_by_key(stored, new, ["order_date"])
    assert as_rows(merged, "order_date", "a", "b") == [(D6, 9, None), (D7, 2, 6)]


def test_failed_replacement_can_be_repeated(spark, tmp_path, monkeypatch):
    """Stored rows of a touched month survive a replacement that breaks off."""
    from daybook.sinks import upsert as module

    target = str(tmp_path / "kpis")
    stored = category_rows(spark, ("A", D6, 1), ("B", D6, 2))
    upsert(spark, stored, target, CATEGORY_KPI, CATEGORY_KPI_KEYS, str(tmp_path / "s1"))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(module, "put_state", broken)
        with pytest.raises(RuntimeError):
            upsert(
                spark,
                category_rows(spark, ("B", D6, 9)),
                target,
                CATEGORY_KPI,
                CATEGORY_KPI_KEYS,
                str(tmp_path / "s2"),
            )
    assert as_rows(stored_kpis(spark, target, CATEGORY_KPI), "category", "daily_revenue") == [
        ("A", Decimal("1.00")),
        ("B", Decimal("2.00")),
    ]
    upsert(
        spark,
        category_rows(spark, ("B", D6, 9)),
        target,
        CATEGORY_KPI,
        CATEGORY_KPI_KEYS,
        str(tmp_path / "s2"),
    )
    assert as_rows(stored_kpis(spark, target, CATEGORY_KPI), "category", "daily_revenue") == [
        ("A", Decimal("1.00")),
        ("B", Decimal("9.00")),
    ]
