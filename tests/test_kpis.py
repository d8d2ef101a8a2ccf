import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.operators import kpis
from daybook.operators.cleaning import clean_items, clean_orders
from daybook.schemas import CATEGORY_KPI, ORDER_KPI
from tests.conftest import as_rows

D6, D7 = dt.date(2025, 7, 6), dt.date(2025, 7, 7)


def test_golden_category_kpis(golden):
    _, items, products = golden
    result = kpis.category_kpis(clean_items(items), products)
    assert as_rows(result, *CATEGORY_KPI.names) == [
        ("Books", D6, Decimal("32.01"), 16.005, 0.5),
        ("Toys", D6, Decimal("5.50"), 5.5, 1.0),
    ]
    assert [f.dataType for f in result.schema] == [f.dataType for f in CATEGORY_KPI]


def test_golden_order_kpis(golden):
    orders, items, _ = golden
    result = kpis.order_kpis(clean_orders(orders), clean_items(items))
    assert as_rows(result, *ORDER_KPI.names) == [
        (D6, 3, Decimal("37.51"), 4, 1 / 3, 2),
        (D7, 1, Decimal("7.00"), None, 0.0, 1),
    ]
    assert [f.dataType for f in result.schema] == [f.dataType for f in ORDER_KPI]


def test_repeated_orders_count_once_but_weigh_twice(text_table, golden):
    orders, items, _ = golden
    twice = orders.unionByName(orders.where("order_id = '1'"))
    row = kpis.order_kpis(clean_orders(twice), clean_items(items)).where(
        F.col("order_date") == D6
    ).first()
    assert row["total_orders"] == 3
    assert row["total_revenue"] == Decimal("37.51") + Decimal("17.51")
    assert row["total_items_sold"] == 6
    assert row["return_rate"] == 1 / 4
    assert row["unique_customers"] == 2


def test_null_keys_make_groups_of_their_own(text_table):
    orders = text_table(
        "order_id,user_id,created_at,status,num_of_item\n"
        ",10,2025-07-06,complete,1\n,,2025-07-06,returned,2\n5,10,garbage,complete,3\n"
    )
    items = text_table(
        "order_id,product_id,created_at,sale_price,status\n,1,2025-07-06,9.00,complete\n"
        "5,1,garbage,1.00,complete\n5,,2025-07-06,1.00,complete\n"
    )
    products = text_table("id,category\n1,\n,Toys\n")
    assert as_rows(kpis.order_kpis(clean_orders(orders), clean_items(items)), *ORDER_KPI.names) == [
        (None, 1, Decimal("2.00"), 3, 0.0, 1),
        (D6, 0, None, 3, 0.5, 1),
    ]
    assert as_rows(kpis.category_kpis(clean_items(items), products), *CATEGORY_KPI.names) == [
        (None, None, Decimal("1.00"), 1.0, 0.0),
        (None, D6, Decimal("9.00"), 9.0, 0.0),
    ]


def test_repeated_product_ids_repeat_items(golden, text_table):
    _, items, _ = golden
    products = text_table("id,category\n100,Books\n100,Books\n101,Toys\n")
    result = kpis.category_kpis(clean_items(items), products).where("category = 'Books'").first()
    assert result["daily_revenue"] == Decimal("64.02")


def test_products_may_share_names_with_items(golden):
    _, items, products = golden
    wide = products.withColumns({"order_id": F.lit("x"), "order_date": F.lit("y")})
    items = items.withColumns({"id": F.lit("7"), "category": F.lit("own")})
    plain = kpis.category_kpis(clean_items(items), products)
    assert as_rows(kpis.category_kpis(clean_items(items), wide), *CATEGORY_KPI.names) == as_rows(
        plain, *CATEGORY_KPI.names
    )


def test_all_values_unknown(text_table):
    items = text_table(
        "order_id,product_id,created_at,sale_price,status\n1,1,2025-07-06,bad,complete\n"
    )
    products = text_table("id,category\n1,Books\n")
    row = kpis.category_kpis(clean_items(items), products).first()
    assert (row["daily_revenue"], row["avg_order_value"], row["avg_return_rate"]) == (None, None, 0.0)


def brute_force(orders, items, products):
    """Both KPI tables by plain Python loops over typed tuples."""
    cents = lambda value: None if value is None else Decimal(value)
    category = {}
    for order_id, product_id, day, price, status in items:
        for pid, name in products:
            if pid == product_id and pid is not None:
                values = category.setdefault((name, day), {}).setdefault(order_id, [[], 0])
                if price is not None:
                    values[0].append(cents(price))
                values[1] |= status == "returned"
    category_rows = []
    for (name, day), per_order in category.items():
        sums = [sum(v) for v, _ in per_order.values() if v]
        flags = [flag for _, flag in per_order.values()]
        total = sum(sums) if sums else None
        category_rows.append(
            (name, day, total, float(total) / len(sums) if sums else None, sum(flags) / len(flags))
        )
    revenue = {}
    for order_id, _, _, price, _ in items:
        if order_id is not None and price is not None:
            revenue[order_id] = revenue.get(order_id, Decimal(0)) + cents(price)
    days = {}
    for row in orders:
        days.setdefault(row[2], []).append(row)
    order_rows = []
    for day, rows in days.items():
        values = [revenue[r[0]] for r in rows if r[0] in revenue]
        counts = [r[4] for r in rows if r[4] is not None]
        order_rows.append(
            (
                day,
                len({r[0] for r in rows if r[0] is not None}),
                sum(values) if values else None,
                sum(counts) if counts else None,
                sum(r[3] == "returned" for r in rows) / len(rows),
                len({r[1] for r in rows if r[1] is not None}),
            )
        )
    return category_rows, order_rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    """Random rows with NULLs, repeated orders, and one hot order, product and user."""
    rng = random.Random(seed)
    days = [D6, D7, dt.date(2025, 8, 1), None]
    hot = lambda pool: pool[0] if rng.random() < 0.33 else rng.choice(pool)
    ids = ["o0"] + [f"o{i}" for i in range(40)] + [None]
    users = ["u0"] + [f"u{i}" for i in range(9)] + [None]
    skus = ["p0"] + [f"p{i}" for i in range(12)] + [None]
    status = ["complete", "returned", "Returned", None]
    orders = [
        (hot(ids), hot(users), rng.choice(days), rng.choice(status), rng.choice([1, 2, 3, None]))
        for _ in range(300)
    ]
    items = [
        (
            hot(ids),
            hot(skus),
            rng.choice(days),
            rng.choice([None, f"{rng.randint(0, 9999)}.{rng.randint(0, 99):02d}"]),
            rng.choice(status),
        )
        for _ in range(900)
    ]
    products = [(f"p{i}", f"c{i % 4}") for i in range(10)] + [("p3", "c9"), (None, "c0")]

    order_df = spark.createDataFrame(
        orders, "order_id string, user_id string, created_at date, status string, num_of_item int"
    )
    item_df = spark.createDataFrame(
        items,
        "order_id string, product_id string, created_at date, sale_price string, status string",
    )
    product_df = spark.createDataFrame(products, "id string, category string")
    categories, totals = brute_force(orders, items, products)

    def rounded(rows):
        return sorted(
            (tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows),
            key=str,
        )

    found = kpis.category_kpis(clean_items(item_df), product_df)
    assert rounded(map(tuple, found.select(*CATEGORY_KPI.names).collect())) == rounded(categories)
    found = kpis.order_kpis(clean_orders(order_df), clean_items(item_df))
    assert rounded(map(tuple, found.select(*ORDER_KPI.names).collect())) == rounded(totals)


def test_revenue_adds_up_and_rates_are_rates(golden):
    orders, items, products = golden
    cleaned = clean_items(items)
    category = kpis.category_kpis(cleaned, products)
    missing = kpis.reconciliation(cleaned, products).first()
    total = cleaned.agg(F.sum("sale_price")).first()[0]
    assert category.agg(F.sum("daily_revenue")).first()[0] + missing["revenue_without_product"] == total
    assert missing["items_without_product"] == 1
    assert category.where("NOT avg_return_rate BETWEEN 0 AND 1").count() == 0


def test_lines_stand_in_for_item_counts(golden):
    orders, items, _ = golden
    result = kpis.order_kpis(
        clean_orders(orders.drop("num_of_item")), clean_items(items), count_lines=True
    )
    assert as_rows(result, "order_date", "total_items_sold") == [(D6, 4), (D7, 1)]


def test_row_order_and_splits_do_not_matter(golden):
    orders, items, products = golden
    shuffled = kpis.category_kpis(clean_items(items.orderBy(F.desc("sale_price")).repartition(3)), products)
    plain = kpis.category_kpis(clean_items(items), products)
    assert as_rows(shuffled, *CATEGORY_KPI.names) == as_rows(plain, *CATEGORY_KPI.names)
