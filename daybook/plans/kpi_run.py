"""The KPI job: new valid files -> partial sums -> both KPI tables -> ledger, in one commit."""

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.kpis import category_kpis, order_kpis
from daybook.operators.ledger import latest_files, new_files
from daybook.plans.gate_run import new_run_id
from daybook.plans.kpi_parts import compact_parts, is_built, kpis_of_days, touched_days, write_delivery
from daybook.plans.workspace import Workspace
from daybook.schemas import (
    CATEGORY_KPI,
    CATEGORY_KPI_KEYS,
    CLEAN_ROWS,
    FILE_IDENTITY,
    GATE_LOG,
    LEDGER,
    ORDER_KPI,
    ORDER_KPI_KEYS,
    REQUIRED_COLUMNS,
    VALID,
)
from daybook.session import at_once
from daybook.sinks.ledger import compact_ledger, mark_processed
from daybook.sinks.upsert import apply_staged, stage, stored_kpis
from daybook.sinks.versions import Commit
from daybook.sources.csv_batches import read_csv
from daybook.sources.files import latest_delivery
from daybook.sources.tables import path_exists, read_partitions, read_table, small_rows


@dataclass(frozen=True)
class KpiRun:
    """What a run did: the files it took, the staged KPI rows, and how many there are of each."""

    run_id: str
    files: DataFrame
    category_rows: DataFrame
    order_rows: DataFrame
    counts: dict[str, int]

    def summary(self) -> DataFrame:
        """(output, n_rows), as counted while the run wrote them: no table is read again."""
        return self.files.sparkSession.createDataFrame(list(self.counts.items()), "output string, n_rows bigint")


def valid_files(spark: SparkSession, workspace: Workspace) -> DataFrame:
    """Valid order and item files of all committed gate runs."""
    return read_table(spark, workspace.gate_log, GATE_LOG).where(
        (F.col("verdict") == VALID) & F.col("file_type").isin(list(REQUIRED_COLUMNS))
    )


def pending_files(spark: SparkSession, workspace: Workspace, latest_only: bool) -> DataFrame:
    """Valid files that the ledger does not know.

    A file is known by its path and time, so files of one name in different
    folders are different files, and so is one that lands again at its old
    path: its rows come in addition. `latest_only` takes the last file of each
    type and leaves the others for later runs.
    """
    valid = valid_files(spark, workspace)
    pending = new_files(valid, read_table(spark, workspace.ledger, LEDGER))
    if latest_only:
        pending = valid.join(latest_files(pending).select(*FILE_IDENTITY), FILE_IDENTITY, "left_semi")
    return pending


def known_files(spark: SparkSession, workspace: Workspace) -> DataFrame:
    """Valid files that were processed before."""
    known = read_table(spark, workspace.ledger, LEDGER).select(*FILE_IDENTITY)
    return valid_files(spark, workspace).join(known, FILE_IDENTITY, "left_semi")


@dataclass(frozen=True)
class GateRun:
    """A gate run with files of one type to read, by number."""

    file_type: str
    folder: str
    n_files: int
    n_wanted: int


def gate_runs(spark: SparkSession, workspace: Workspace, wanted: DataFrame) -> list[GateRun]:
    """The runs of some files: how many files each has, how many are wanted."""
    keys = ["file_type", "dt", "run_id"]
    asked = wanted.groupBy(*keys).agg(F.count("*").alias("n_wanted"))
    valid = valid_files(spark, workspace).groupBy(*keys).agg(F.count("*").alias("n_files"))
    return [
        GateRun(
            row["file_type"], f"dt={row['dt']}/run_id={row['run_id']}", row["n_files"], row["n_wanted"]
        )
        for row in small_rows(asked.join(valid, keys))
    ]


def rows_of(
    spark: SparkSession, workspace: Workspace, files: DataFrame, runs: list[GateRun], file_type: str
) -> DataFrame:
    """Clean rows of the given files, which lie in the given runs.

    Only the folders of these runs are read, and rows are matched with files
    only in runs that also have others.
    """
    runs = [run for run in runs if run.file_type == file_type]
    whole = [run.folder for run in runs if run.n_wanted == run.n_files]
    partial = [run.folder for run in runs if run.n_wanted < run.n_files]
    table, schema = workspace.clean(file_type), CLEAN_ROWS[file_type]
    rows = read_partitions(spark, table, schema, whole)
    if partial:
        named = files.select(F.col("path").alias("source_file"), "run_id")
        some = read_partitions(spark, table, schema, partial)
        rows = rows.unionByName(some.join(named, ["source_file", "run_id"], "left_semi"))
    return rows


def run_kpis(
    spark: SparkSession,
    workspace: Workspace,
    latest_only: bool = False,
    recompute: bool = True,
    run_id: str | None = None,
    processed_at: dt.datetime | None = None,
) -> KpiRun | None:
    """Process the new valid files once; None if either type has no new file.

    KPI rows replace stored rows of the same key. They come from the partial
    sums of the touched days, those of earlier deliveries included, which is
    right also when one day is spread over several files; without `recompute`
    they come from the new files alone. Partial sums, both KPI tables and the
    ledger change in one commit: a run that dies before it leaves everything as
    it was and is repeated with the same files, and none counts twice.
    """
    run_id = run_id or new_run_id()
    work = f"{workspace.staging(run_id)}/kpis"
    pending_files(spark, workspace, latest_only).write.mode("overwrite").parquet(f"{work}/files")
    wanted = spark.read.schema(GATE_LOG).parquet(f"{work}/files")
    runs = gate_runs(spark, workspace, wanted)
    if {run.file_type for run in runs} != set(REQUIRED_COLUMNS):
        return None

    orders, items = (rows_of(spark, workspace, wanted, runs, t) for t in REQUIRED_COLUMNS)
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"
    added = [orders, items]
    if not is_built(spark, workspace) and path_exists(spark, workspace.ledger):  # from before the sums were kept
        counted = wanted.unionByName(known_files(spark, workspace))
        every = gate_runs(spark, workspace, counted)
        added = [rows_of(spark, workspace, counted, every, t) for t in REQUIRED_COLUMNS]
    delivery = write_delivery(spark, workspace, *added, f"{work}/delivery", version)
    products = read_csv(spark, latest_delivery(spark, workspace.products))
    if recompute:
        days = touched_days(spark, workspace, delivery)
        category_rows, order_rows = kpis_of_days(spark, workspace, delivery, days, products)
    else:
        category_rows, order_rows = category_kpis(items, products), order_kpis(orders, items)

    tables = {
        "category": (category_rows, workspace.category_kpis, CATEGORY_KPI, CATEGORY_KPI_KEYS),
        "order": (order_rows, workspace.order_kpis, ORDER_KPI, ORDER_KPI_KEYS),
    }
    commit = Commit(spark, workspace.root.rstrip("/"), version)

    def store(name: str) -> int:
        rows, target, schema, keys = tables[name]
        n_rows = stage(rows, f"{work}/{name}", schema, keys)
        apply_staged(spark, f"{work}/{name}", target, schema, keys, commit)
        return n_rows

    *stored, _ = at_once(
        *[partial(store, name) for name in tables],
        lambda: mark_processed(wanted, workspace.ledger, processed_at, commit),
    )
    counts = {f"{name}_kpis": n_rows for name, n_rows in zip(tables, stored)}
    delivery.commit(workspace, commit)
    commit.finish()
    compact_parts(spark, workspace)
    compact_ledger(spark, workspace.ledger)
    for file_type in REQUIRED_COLUMNS:
        counts[f"{file_type}_files"] = sum(run.n_wanted for run in runs if run.file_type == file_type)
    return KpiRun(
        run_id,
        wanted,
        stored_kpis(spark, f"{work}/category", CATEGORY_KPI),
        stored_kpis(spark, f"{work}/order", ORDER_KPI),
        counts,
    )
