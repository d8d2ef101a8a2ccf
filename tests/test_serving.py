import datetime as dt
from decimal import Decimal

import pytest

from daybook.operators import serving
from daybook.schemas import CATEGORY_KPI, CATEGORY_KPI_KEYS, ORDER_KPI
from daybook.sinks.upsert import stored_kpis, upsert
from tests.conftest import as_rows
from tests.planning import scans

DAYS = [dt.date(2025, 6, 30), dt.date(2025, 7, 6), dt.date(2025, 7, 31), dt.date(2025, 8, 1)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("serving")
    rows = [
        (c, d, Decimal(i), float(i), 0.0) for c in ("A", "B") for i, d in enumerate(DAYS, start=1)
    ]
    kpis = spark.createDataFrame(rows, CATEGORY_KPI)
    upsert(spark, kpis, str(folder / "t"), CATEGORY_KPI, CATEGORY_KPI_KEYS, str(folder / "s"))
    return stored_kpis(spark, str(folder / "t"), CATEGORY_KPI)


def test_range_includes_both_ends(stored):
    found = serving.category_range(stored, "A", "2025-07-06", "2025-07-31")
    assert as_rows(found, "category", "order_date") == [("A", DAYS[1]), ("A", DAYS[2])]
    assert found.columns == CATEGORY_KPI.names


def test_range_reads_its_months_only(stored):
    plan = scans(serving.category_range(stored, "A", "2025-07-01", "2025-07-31"))
    assert len(plan) == 1
    assert "2025-07" in plan[0]["PartitionFilters"]
    assert "EqualTo(category,A)" in plan[0]["PushedFilters"]


def test_one_day(stored):
    found = serving.category_day(stored, "B", DAYS[3])
    assert as_rows(found, "category", "daily_revenue") == [("B", Decimal("4.00"))]


def test_revenue_by_category(stored):
    assert as_rows(serving.revenue_by_category(stored), "category", "revenue") == [
        ("A", Decimal("10.00")),
        ("B", Decimal("10.00")),
    ]


def test_order_kpi_views(spark):
    rows = [(d, 2, Decimal(i), 3, 0.5, 2) for i, d in enumerate(DAYS)]
    kpis = spark.createDataFrame(list(reversed(rows)), ORDER_KPI)
    assert serving.day_range(kpis, DAYS[1], DAYS[2]).count() == 2
    assert [row["order_date"] for row in serving.trend(kpis).collect()] == DAYS
    orders = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "user_id string")
    assert tuple(serving.headline_totals(kpis, orders).first()) == (8, 2)
