"""Keyed upsert into KPI tables stored by month."""

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.functions.casting import month_of
from daybook.operators.merge import complete_keys, merge_by_key
from daybook.sinks.versions import Commit, put_state, take_over, write_rows
from daybook.sources.tables import read_table, small_rows
from daybook.sources.versions import read_folders, read_state

MONTH = "order_month"


def stored_kpis(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The KPI table with its `order_month` partition column."""
    return read_table(spark, path, StructType([*schema.fields]).add(MONTH, "string"))


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """The columns of the table, in its order and its types."""
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def stage(rows: DataFrame, path: str, schema: StructType, keys: list[str]) -> int:
    """Write KPI rows that can be stored to a table of their own; return how many, counted while they are written.

    Nothing shuffles after the count, so a task that is repeated counts once.
    """
    storable = complete_keys(conform(rows, schema), keys).withColumn(MONTH, month_of("order_date"))
    written = Observation()
    counted = storable.observe(written, F.count(F.lit(1)).alias("n_rows"))
    counted.write.mode("overwrite").parquet(path)
    return written.get["n_rows"]


def apply_staged(
    spark: SparkSession,
    staged_path: str,
    target_path: str,
    schema: StructType,
    keys: list[str],
    commit: Commit | None = None,
) -> None:
    """Merge staged rows into the target, one whole row per key, last write wins.

    Only the months that have new rows are read and written again, to folders
    of their own. The table changes with its next state: at once, or with
    `commit`. A run that dies before that leaves the table as it was.
    """
    staged = stored_kpis(spark, staged_path, schema)
    months = [row[0] for row in small_rows(staged.select(MONTH).distinct())]
    if not months:
        return
    take_over(spark, target_path, schema, MONTH)
    base = read_state(spark, target_path)
    full = StructType([*schema.fields]).add(MONTH, "string")
    old = [f for month in months for f in base.folders.get(month, ())]
    rows = merge_by_key(read_folders(spark, target_path, full, old), staged, keys) if old else staged
    written = write_rows(rows, target_path, uuid.uuid4().hex, MONTH, tuple(keys))
    folders = base.folders | {month: [folder] for month, folder in written.items()}
    if commit is not None:
        commit.prepare(target_path, base, folders)
    else:
        put_state(spark, target_path, base, folders)


def upsert(
    spark: SparkSession,
    rows: DataFrame,
    target_path: str,
    schema: StructType,
    keys: list[str],
    scratch: str,
) -> None:
    """Stage, merge and replace in one call."""
    stage(rows, f"{scratch}/new", schema, keys)
    apply_staged(spark, f"{scratch}/new", target_path, schema, keys)
