import datetime as dt
import random
import shutil
from decimal import Decimal

import pytest

from daybook.operators import kpis
from daybook.plans import kpi_parts, kpi_run
from daybook.plans.gate_run import run_gate
from daybook.plans.kpi_run import run_kpis
from daybook.schemas import CATEGORY_KPI, ORDER_KPI
from daybook.sinks import versions
from daybook.sinks.upsert import stored_kpis
from daybook.sources.tables import read_ledger
from daybook.streaming.kpi_stream import stream_kpis
from tests.conftest import as_rows
from tests.landing import golden_workspace, put
from tests.planning import scans

D6, D7 = dt.date(2025, 7, 6), dt.date(2025, 7, 7)
GOLDEN_CATEGORIES = [
    ("Books", D6, Decimal("32.01"), 16.005, 0.5),
    ("Toys", D6, Decimal("5.50"), 5.5, 1.0),
]
GOLDEN_DAYS = [
    (D6, 3, Decimal("37.51"), 4, 1 / 3, 2),
    (D7, 1, Decimal("7.00"), None, 0.0, 1),
]
MORE_ORDERS = """
order_id,user_id,created_at,status,num_of_item
5,13,2025-07-06 12:00:00,complete,1
"""
MORE_ITEMS = """
order_id,product_id,created_at,sale_price,status
5,100,2025-07-06 12:00:00,4.00,complete
3,101,2025-07-07 11:00:00,1.00,complete
"""


def category_table(spark, workspace):
    return as_rows(stored_kpis(spark, workspace.category_kpis, CATEGORY_KPI), *CATEGORY_KPI.names)


def order_table(spark, workspace):
    return as_rows(stored_kpis(spark, workspace.order_kpis, ORDER_KPI), *ORDER_KPI.names)


def land_more(workspace):
    put(workspace, "incoming/orders/batch2.csv", MORE_ORDERS)
    put(workspace, "incoming/order_items/batch2.csv", MORE_ITEMS)


def test_files_to_kpis_once(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1")
    run = run_kpis(spark, workspace, run_id="k1")
    assert category_table(spark, workspace) == GOLDEN_CATEGORIES
    assert order_table(spark, workspace) == GOLDEN_DAYS
    assert as_rows(run.summary(), "output", "n_rows") == [
        ("category_kpis", 2),
        ("order_items_files", 1),
        ("order_kpis", 2),
        ("orders_files", 1),
    ]
    assert as_rows(read_ledger(spark, workspace.ledger), "file_key") == [
        ("validated/order_items/dt=2025-07-07/batch1.csv",),
        ("validated/orders/dt=2025-07-07/batch1.csv",),
    ]
    assert run_kpis(spark, workspace) is None


def test_one_type_alone_waits(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    (tmp_path / "incoming/order_items/batch1.csv").rename(tmp_path / "later.csv")
    run_gate(spark, workspace, D7, "g1")
    assert run_kpis(spark, workspace) is None
    assert read_ledger(spark, workspace.ledger).count() == 0
    (tmp_path / "later.csv").rename(tmp_path / "incoming/order_items/batch1.csv")
    run_gate(spark, workspace, D7, "g2")
    assert run_kpis(spark, workspace) is not None
    assert order_table(spark, workspace) == GOLDEN_DAYS


def test_missing_products_are_an_error(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    for path in (tmp_path / "static").iterdir():
        path.rename(tmp_path / path.name)
    run_gate(spark, workspace, D7, "g1")
    with pytest.raises(FileNotFoundError):
        run_kpis(spark, workspace)
    assert read_ledger(spark, workspace.ledger).count() == 0


def test_replace_takes_the_new_files_alone(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1")
    run_kpis(spark, workspace)
    land_more(workspace)
    run_gate(spark, workspace, D7, "g2")
    run_kpis(spark, workspace, recompute=False)
    assert order_table(spark, workspace) == [
        (D6, 1, Decimal("4.00"), 1, 0.0, 1),
        GOLDEN_DAYS[1],
    ]
    assert category_table(spark, workspace) == [
        ("Books", D6, Decimal("4.00"), 4.0, 0.0),
        GOLDEN_CATEGORIES[1],
        ("Toys", D7, Decimal("1.00"), 1.0, 0.0),
    ]


RECOMPUTED_DAYS = [
    # Order 5 is new, and order 3 gets its first item.
    (D6, 4, Decimal("42.51"), 5, 1 / 4, 3),
    GOLDEN_DAYS[1],
]


def recomputed_categories():
    return [
        ("Books", D6, Decimal("36.01"), 36.01 / 3, 1 / 3),
        GOLDEN_CATEGORIES[1],
        ("Toys", D7, Decimal("1.00"), 1.0, 0.0),
    ]


def test_recompute_takes_all_rows_of_the_touched_days(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1")
    run_kpis(spark, workspace)
    land_more(workspace)
    run_gate(spark, workspace, D7, "g2")
    run_kpis(spark, workspace)
    assert order_table(spark, workspace) == RECOMPUTED_DAYS
    assert category_table(spark, workspace) == recomputed_categories()


def test_all_files_together_equal_recompute(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    land_more(workspace)
    run_gate(spark, workspace, D7, "g1")
    run_kpis(spark, workspace)
    assert order_table(spark, workspace) == RECOMPUTED_DAYS
    assert category_table(spark, workspace) == recomputed_categories()


def test_latest_only_takes_one_file_per_type(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    land_more(workspace)
    run_gate(spark, workspace, D7, "g1")
    run_kpis(spark, workspace, latest_only=True, recompute=False)
    assert order_table(spark, workspace) == [(D6, 1, Decimal("4.00"), 1, 0.0, 1)]
    run_kpis(spark, workspace, latest_only=True, recompute=False)
    assert order_table(spark, workspace) == GOLDEN_DAYS
    assert run_kpis(spark, workspace, latest_only=True) is None


def test_files_of_one_name_are_different_files(spark, tmp_path):
    """Equal base names in one run and in two, and a name that lands again."""
    workspace = golden_workspace(tmp_path)
    head_orders, head_items = (text.strip().splitlines()[0] for text in (MORE_ORDERS, MORE_ITEMS))
    for k, folder in ((21, "a"), (22, "b")):
        put(workspace, f"incoming/orders/{folder}/x.csv", f"{head_orders}\n{k},1{k},2025-07-06,complete,1\n")
        put(workspace, f"incoming/order_items/{folder}/x.csv", f"{head_items}\n{k},100,2025-07-06,1.00,complete\n")
    run_gate(spark, workspace, D7, "g1")
    run = run_kpis(spark, workspace)
    assert dict(as_rows(run.summary(), "output", "n_rows"))["orders_files"] == 3
    assert order_table(spark, workspace)[0] == (D6, 5, Decimal("39.51"), 6, 1 / 5, 4)
    for file_type, text in (("orders", MORE_ORDERS), ("order_items", MORE_ITEMS)):
        put(workspace, f"incoming/{file_type}/c/x.csv", text)
    put(workspace, "incoming/orders/batch1.csv", MORE_ORDERS.replace("5,13", "6,14"))
    assert run_gate(spark, workspace, D7, "g2").count() == 3
    run = run_kpis(spark, workspace)
    assert run.files.count() == 3
    assert order_table(spark, workspace)[0] == (D6, 7, Decimal("44.51"), 8, 1 / 7, 6)
    assert run_kpis(spark, workspace) is None


def test_all_files_of_the_last_product_delivery_count(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    put(workspace, "static/products_2025-07-03/part-1.csv", "id,category\n100,Books\n")
    put(workspace, "static/products_2025-07-03/part-2.csv", "id,category\n101,Toys\n")
    put(workspace, "static/products_2025-07-04/notes.txt", "no delivery")
    put(workspace, "static/_later/products.csv", "id,category\n100,Hidden\n")
    run_gate(spark, workspace, D7, "g1")
    run_kpis(spark, workspace)
    assert category_table(spark, workspace) == GOLDEN_CATEGORIES


def test_a_broken_run_is_repeated(spark, tmp_path, monkeypatch):
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1")
    with monkeypatch.context() as patch:
        patch.setattr(kpi_run, "mark_processed", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run_kpis(spark, workspace)
    run_kpis(spark, workspace)
    assert order_table(spark, workspace) == GOLDEN_DAYS
    assert category_table(spark, workspace) == GOLDEN_CATEGORIES


def test_rows_of_an_uncommitted_gate_run_do_not_count(spark, tmp_path, monkeypatch):
    from daybook.plans import gate_run

    workspace = golden_workspace(tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(
            gate_run, "write_manifest", lambda *_: (_ for _ in ()).throw(OSError("lost"))
        )
        with pytest.raises(OSError):
            run_gate(spark, workspace, D7, "g1")
    run_gate(spark, workspace, D7, "g2")
    run_kpis(spark, workspace)
    assert order_table(spark, workspace) == GOLDEN_DAYS


def test_items_and_orders_far_apart(spark, tmp_path):
    """Items and orders far apart in time, in three deliveries."""
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1")
    run_kpis(spark, workspace)
    head_orders, head_items = (text.strip().splitlines()[0] for text in (MORE_ORDERS, MORE_ITEMS))
    put(  # an item of an order that is not there yet, one without a day, and one of a known order
        workspace,
        "incoming/order_items/early.csv",
        f"{head_items}\n70,100,2024-01-05,3.00,complete\n70,100,bad,0.50,complete\n2,100,2026-02-01,1.00,complete\n",
    )
    put(workspace, "incoming/orders/other.csv", f"{head_orders}\n60,16,2025-09-01,complete,1\n")
    run_gate(spark, workspace, D7, "g2")
    run_kpis(spark, workspace)
    put(workspace, "incoming/orders/late.csv", f"{head_orders}\n70,17,2025-07-07,complete,1\n")
    put(workspace, "incoming/order_items/late.csv", f"{head_items}\n60,101,2025-09-01,9.00,complete\n")
    run_gate(spark, workspace, D7, "g3")
    run_kpis(spark, workspace)
    assert order_table(spark, workspace) == [
        (D6, 3, Decimal("38.51"), 4, 1 / 3, 2),
        (D7, 2, Decimal("10.50"), 1, 0.0, 2),
        (dt.date(2025, 9, 1), 1, Decimal("9.00"), 1, 0.0, 1),
    ]


def deliver(spark, workspace, name, orders, items):
    """One gate run with an order file and an item file; `orders` are (id, user, day), `items` (id, product, day, price)."""
    heads = [text.strip().splitlines()[0] for text in (MORE_ORDERS, MORE_ITEMS)]
    lines = [
        "".join(f"{i},{u},{d},complete,1\n" for i, u, d in orders),
        "".join(f"{i},{p},{d},{price},complete\n" for i, p, d, price in items),
    ]
    for file_type, head, text in zip(("orders", "order_items"), heads, lines):
        put(workspace, f"incoming/{file_type}/{name}.csv", f"{head}\n{text}")
    run_gate(spark, workspace, D7, name)


def test_a_delivery_reads_no_typed_row_of_another(spark, tmp_path):
    """Typed rows of earlier runs are gone, and a delivery still gets its days right."""
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1")
    run_kpis(spark, workspace)
    for file_type in ("orders", "order_items"):
        shutil.rmtree(tmp_path / f"validated/{file_type}/dt=2025-07-07/run_id=g1")
    land_more(workspace)
    run_gate(spark, workspace, D7, "g2")
    run_kpis(spark, workspace)
    assert order_table(spark, workspace) == RECOMPUTED_DAYS
    assert category_table(spark, workspace) == recomputed_categories()


def test_days_come_from_pruned_sums(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    deliver(spark, workspace, "g0", [(1, 1, "2025-05-01")], [(1, 100, "2025-05-01", "1.00")])
    run_kpis(spark, workspace)
    delivery = kpi_parts.Delivery({name: {} for name in kpi_parts.PARTS})
    days = {"category": [D6], "order": [D6, D7]}
    products = spark.createDataFrame([("100", "Books"), ("101", "Toys")], "id string, category string")
    for rows in kpi_parts.kpis_of_days(spark, workspace, delivery, days, products):
        for scan in scans(rows):
            assert "order_month" in scan["PartitionFilters"] and "order_date" in scan["PushedFilters"]
        stored = [f for f in rows.inputFiles() if "/parts/" in f]
        assert stored and not [f for f in stored if "2025-05" in f]


def random_deliveries(seed, n):
    """Orders over several days and deliveries, items before, with and after them, and without any."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        orders = [(rng.randrange(8), rng.randrange(4), dt.date(2025, rng.choice((6, 7)), rng.randrange(1, 4))) for _ in range(4)]
        items = [
            (rng.randrange(9), rng.choice((100, 101, 7)), rng.choice(("2025-06-30", "2025-07-01", "bad")), f"{rng.randrange(900) / 100:.2f}")
            for _ in range(5)
        ]
        out.append((orders, items))
    return out


def test_deliveries_in_turn_equal_all_at_once(spark, tmp_path):
    turns, once = golden_workspace(tmp_path / "turns"), golden_workspace(tmp_path / "once")
    for k, (orders, items) in enumerate(random_deliveries(1, 3)):
        deliver(spark, turns, f"g{k}", orders, items)
        run_kpis(spark, turns)
        deliver(spark, once, f"g{k}", orders, items)
    run_kpis(spark, once)
    assert order_table(spark, turns) == order_table(spark, once)
    assert category_table(spark, turns) == category_table(spark, once)
    # and both as the rows themselves say
    orders, items = (
        kpi_run.rows_of(spark, once, files, kpi_run.gate_runs(spark, once, files), t)
        for files in [kpi_run.known_files(spark, once)]
        for t in ("orders", "order_items")
    )
    plain = kpis.order_kpis(orders, items).where("order_date IS NOT NULL")
    assert order_table(spark, once) == as_rows(plain, *ORDER_KPI.names)


def test_a_killed_run_changes_nothing_and_the_next_needs_no_hand(spark, tmp_path, monkeypatch):
    """The run ends between its last write and its commit."""
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1")
    run_kpis(spark, workspace)
    before = order_table(spark, workspace), category_table(spark, workspace), read_ledger(spark, workspace.ledger).count()
    land_more(workspace)
    run_gate(spark, workspace, D7, "g2")
    with monkeypatch.context() as patch:
        real = versions.create_once

        def killed(session, path, text):
            if "/commits/" in path:
                raise OSError("lost")
            real(session, path, text)

        patch.setattr(versions, "create_once", killed)
        with pytest.raises(OSError):
            run_kpis(spark, workspace)
    assert (order_table(spark, workspace), category_table(spark, workspace), read_ledger(spark, workspace.ledger).count()) == before
    run_kpis(spark, workspace)
    assert order_table(spark, workspace) == RECOMPUTED_DAYS
    assert category_table(spark, workspace) == recomputed_categories()
    assert run_kpis(spark, workspace) is None


def test_sums_are_built_from_rows_processed_before_they_were_kept(spark, tmp_path):
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1")
    run_kpis(spark, workspace)
    shutil.rmtree(tmp_path / "parts")
    land_more(workspace)
    run_gate(spark, workspace, D7, "g2")
    run_kpis(spark, workspace)
    assert order_table(spark, workspace) == RECOMPUTED_DAYS


def test_stream_equals_batch(spark, tmp_path):
    workspace = golden_workspace(tmp_path / "w")
    checkpoint = str(tmp_path / "checkpoint")

    def stream():
        query = stream_kpis(spark, workspace, checkpoint)
        query.awaitTermination()
        return query.exception()

    run_gate(spark, workspace, D7, "g1")
    assert stream() is None
    assert order_table(spark, workspace) == GOLDEN_DAYS
    land_more(workspace)
    run_gate(spark, workspace, D7, "g2")
    assert stream() is None
    assert order_table(spark, workspace) == RECOMPUTED_DAYS
    assert category_table(spark, workspace) == recomputed_categories()
    before = read_ledger(spark, workspace.ledger).collect()
    assert stream() is None
    assert read_ledger(spark, workspace.ledger).collect() == before
