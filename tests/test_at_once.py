import datetime as dt
import threading

import pytest

from daybook.plans import gate_run, kpi_parts, kpi_run
from daybook.plans.gate_run import run_gate
from daybook.plans.kpi_run import run_kpis
from daybook.schemas import ORDER_KPI
from daybook.session import at_once
from daybook.sinks.upsert import stored_kpis
from daybook.sources.tables import path_exists, read_ledger
from tests.landing import golden_workspace

D7 = dt.date(2025, 7, 7)


def meeting(call, parties=2):
    """The call, begun only once it has been asked for by that many threads."""
    barrier = threading.Barrier(parties)

    def wait_for_others(*args, **kwargs):
        barrier.wait(60)
        return call(*args, **kwargs)

    return wait_for_others


def test_results_come_in_order_of_the_steps(spark):
    count = meeting(lambda n: spark.range(n).count(), 3)
    assert at_once(lambda: count(3), lambda: count(1), lambda: count(2)) == [3, 1, 2]
    assert at_once() == []


def test_an_error_comes_after_the_other_steps(spark):
    done = []

    def fails():
        raise ValueError("step")

    with pytest.raises(ValueError, match="step"):
        at_once(fails, lambda: done.append(spark.range(1).count()))
    assert done == [1]


def test_both_types_of_a_gate_run_are_kept_side_by_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(gate_run, "append_run", meeting(gate_run.append_run))
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1", archive=False)
    assert all(path_exists(spark, workspace.clean(name)) for name in ("orders", "order_items"))


def test_sums_and_kpis_of_both_types_are_written_side_by_side(spark, tmp_path, monkeypatch):
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1", archive=False)
    both = meeting(kpi_parts.write_rows)
    typed = lambda path: path.endswith(("parts/items", "parts/orders"))
    write = kpi_parts.write_rows
    monkeypatch.setattr(
        kpi_parts, "write_rows", lambda rows, path, *a, **k: (both if typed(path) else write)(rows, path, *a, **k)
    )
    monkeypatch.setattr(kpi_run, "stage", meeting(kpi_run.stage))
    counts = run_kpis(spark, workspace, run_id="k1").counts
    assert list(counts) == ["category_kpis", "order_kpis", "orders_files", "order_items_files"]
    assert stored_kpis(spark, workspace.order_kpis, ORDER_KPI).count() == counts["order_kpis"] == 2


def test_nothing_counts_if_one_of_the_steps_fails(spark, tmp_path, monkeypatch):
    workspace = golden_workspace(tmp_path)
    run_gate(spark, workspace, D7, "g1", archive=False)
    stage = kpi_run.stage

    def fails(rows, path, *rest):
        if path.endswith("/order"):
            raise OSError("disk")
        return stage(rows, path, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(kpi_run, "stage", fails)
        with pytest.raises(OSError, match="disk"):
            run_kpis(spark, workspace, run_id="k1")
    assert read_ledger(spark, workspace.ledger).count() == 0
    assert run_kpis(spark, workspace, run_id="k2").counts["category_kpis"] == 2
    assert read_ledger(spark, workspace.ledger).count() == 2
