"""The flat variant as a job: files -> row rules -> cleaned rows -> both KPI tables.

A file with one broken row is rejected as a whole, with the reasons in the gate
log; its rows are kept with the rules they break. All judged files are archived.
KPI rows replace stored rows of the same key, in tables of their own; both
tables and the ledger change in one commit.
"""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.flat import clean_flat, flat_category_kpi, flat_daily_kpi
from daybook.operators.quality import check_rows, reason_counts, reasons_by_file, rejected_by_counts, split_by_file
from daybook.plans.gate_run import (
    append_run,
    archive_files,
    in_run,
    judge,
    layouts,
    new_arrivals,
    new_run_id,
    not_logged,
    text_rows,
    utc_today,
)
from daybook.plans.workspace import Workspace
from daybook.schemas import (
    CATEGORY_KPI,
    CATEGORY_KPI_KEYS,
    CLEAN_FLAT,
    FLAT_COLUMNS,
    FLAT_TYPE,
    GATE_LOG,
    ORDER_KPI,
    ORDER_KPI_KEYS,
    REJECTED_FLAT,
    REJECTED_ROWS,
    VALID,
)
from daybook.session import frees_shuffles
from daybook.sinks.ledger import mark_processed
from daybook.sinks.tables import append
from daybook.sinks.upsert import apply_staged, stage
from daybook.sinks.versions import Commit
from daybook.sources.tables import read_partitions


def _with_row_verdicts(verdicts: DataFrame, rejected: DataFrame) -> DataFrame:
    """Valid files with broken rows become rejected ones, with their reasons."""
    reasons = reasons_by_file(rejected).withColumnRenamed("source_file", "path")
    refused = F.col("reasons").isNotNull()
    return (
        verdicts.join(reasons, "path", "left")
        .withColumn("verdict", F.when(refused, REJECTED_ROWS).otherwise(F.col("verdict")))
        .withColumn("problems", F.when(refused, F.col("reasons")).otherwise(F.col("problems")))
        .select(*GATE_LOG.names)
    )


@frees_shuffles
def run_flat(
    spark: SparkSession,
    workspace: Workspace,
    categories: Sequence[str] | DataFrame | None = None,
    run_date: dt.date | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Process the new flat files; return their verdicts."""
    run_date = run_date or utc_today()
    run_id = run_id or new_run_id()
    work = f"{workspace.staging(run_id)}/flat"
    files = new_arrivals(spark, workspace, [FLAT_TYPE], work)
    verdicts = judge(spark, files, run_date, run_id, work, {FLAT_TYPE: FLAT_COLUMNS})
    judged_files = layouts(verdicts)
    rows = text_rows(spark, verdicts, judged_files, FLAT_TYPE, FLAT_COLUMNS, work)
    if rows is None:
        archive_files(spark, workspace, judged_files, run_date, run_id)
        append(not_logged(spark, workspace, verdicts).hint("rebalance"), workspace.gate_log)
        return verdicts

    if isinstance(categories, DataFrame):
        # A written list tells its size, so a short one goes to the rows instead of all rows to it.
        categories.select("category").distinct().write.mode("overwrite").parquet(f"{work}/categories")
        categories = spark.read.parquet(f"{work}/categories")
    dense = {"compression": "zstd"}  # mostly digits
    check_rows(rows, categories).write.mode("overwrite").options(**dense).parquet(f"{work}/checked")
    checked = spark.read.parquet(f"{work}/checked")
    reason_counts(checked).write.mode("overwrite").parquet(f"{work}/reason_counts")
    counts = spark.read.parquet(f"{work}/reason_counts")
    rejected_by_counts(checked, counts).write.mode("overwrite").parquet(f"{work}/rejected")
    rejected = spark.read.parquet(f"{work}/rejected")
    accepted, refused = split_by_file(checked, rejected)
    kept = refused.withColumns({"dt": F.lit(run_date), "run_id": F.lit(run_id)})
    append_run(kept.select(*REJECTED_FLAT.names), workspace.rejected_rows, run_date, run_id, **dense)
    cleaned = in_run(clean_flat(accepted), run_date, run_id).select(*CLEAN_FLAT.names)
    append_run(cleaned, workspace.clean_flat, run_date, run_id, "order_month", **dense)

    _with_row_verdicts(verdicts, rejected).write.mode("overwrite").parquet(f"{work}/judged")
    judged = spark.read.schema(GATE_LOG).parquet(f"{work}/judged")
    archive_files(spark, workspace, layouts(judged), run_date, run_id)
    accepted_files = judged.where(F.col("verdict") == VALID)
    if not accepted_files.isEmpty():
        stored = read_partitions(
            spark, workspace.clean_flat, CLEAN_FLAT, [f"dt={run_date}/run_id={run_id}"]
        )
        stage(flat_category_kpi(stored), f"{work}/category", CATEGORY_KPI, CATEGORY_KPI_KEYS)
        stage(flat_daily_kpi(stored), f"{work}/order", ORDER_KPI, ORDER_KPI_KEYS)
        commit = Commit(spark, workspace.root.rstrip("/"))
        for name, target, schema, keys in (
            ("category", workspace.flat_category_kpis, CATEGORY_KPI, CATEGORY_KPI_KEYS),
            ("order", workspace.flat_order_kpis, ORDER_KPI, ORDER_KPI_KEYS),
        ):
            apply_staged(spark, f"{work}/{name}", target, schema, keys, commit)
        mark_processed(accepted_files, workspace.ledger, commit=commit)
        commit.finish()
    append(not_logged(spark, workspace, judged).hint("rebalance"), workspace.gate_log)
    return judged
