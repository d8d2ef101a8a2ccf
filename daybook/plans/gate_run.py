"""The file gate: judge new files, keep the rows of the valid ones.

Files stay where they landed. Whatever a run writes carries its `run_id`, and
the run counts only once its rows are in the gate log, which is written last.
A run that breaks off leaves rows nobody reads, and its files are judged anew.
"""

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.casting import month_of
from daybook.functions.paths import plain_path
from daybook.operators.cleaning import CLEAN
from daybook.operators.gate import judge_files, profile_lines, ragged_files
from daybook.plans.workspace import Workspace
from daybook.schemas import (
    ARCHIVE_LINES,
    CLEAN_ROWS,
    EMPTY,
    GATE_LOG,
    MISSING_COLUMNS,
    REJECTED_ROWS,
    REQUIRED_COLUMNS,
    UNREADABLE,
    VALID,
)
from daybook.session import at_once
from daybook.sinks.manifest import write_manifest
from daybook.sinks.tables import append
from daybook.sources.csv_batches import read_csv_files
from daybook.sources.files import (
    list_csv_files,
    present,
    read_lines,
    read_raw_lines,
    record_problems,
    stored_records,
    write_records,
)
from daybook.sources.tables import read_table, small_rows


def new_run_id() -> str:
    return f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def utc_today() -> dt.date:
    return dt.datetime.now(dt.UTC).date()


def path_list(files: DataFrame) -> list[str]:
    """File names for a reader. Only names come to the driver, never rows."""
    return [row[0] for row in small_rows(files.select(plain_path("path")))]


def _profiles(
    spark: SparkSession, lines: DataFrame, of_files: Callable[[DataFrame], DataFrame], table: str
) -> DataFrame:
    """Written profiles of files from their lines or records; `of_files` gives those of some files alone."""
    profile_lines(lines).write.mode("overwrite").parquet(table)
    profiles = spark.read.parquet(table)
    uneven = profiles.where("uneven")
    if uneven.isEmpty():
        return profiles
    ragged = ragged_files(of_files(uneven), uneven).withColumn("_ragged", F.lit(True))
    return profiles.join(ragged, "path", "left").withColumn(
        "problems",
        F.when(F.col("_ragged"), F.array_append("problems", F.lit("too many fields"))).otherwise(
            F.col("problems")
        ),
    ).drop("_ragged")


def records_folder(work: str) -> str:
    """Where a run keeps the records of files with quoted line breaks."""
    return f"{work}/multiline"


def profile_files(spark: SparkSession, paths: list[str], work: str) -> DataFrame:
    """Profiles of text files; of those with quoted line breaks the records are written, and profiled."""
    profiles = _profiles(
        spark, read_lines(spark, paths), lambda some: read_lines(spark, path_list(some)), f"{work}/profiles"
    )
    columns = ["path", "header", "n_rows", "multiline", "problems"]
    multiline = path_list(spark.read.parquet(f"{work}/profiles").where("multiline"))
    if not multiline:
        return profiles.select(columns)
    folder = records_folder(work)
    write_records(spark, multiline, folder)
    written = stored_records(spark, folder)
    records = (
        _profiles(
            spark, written,
            lambda some: written.join(some.select("path"), "path", "left_semi"),
            f"{work}/record_profiles",
        )
        .join(record_problems(spark, folder), "path", "left")
        .withColumn(
            "problems", F.concat("problems", F.coalesce("found", F.array().cast("array<string>")))
        )
        .withColumn("multiline", F.lit(True))
    )
    return profiles.where("NOT multiline").select(columns).unionByName(records.select(columns))


def judge(
    spark: SparkSession,
    files: DataFrame,
    run_date: dt.date,
    run_id: str,
    work: str,
    required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS,
) -> DataFrame:
    """Verdicts of listed files (file_type, path, length, modified_at, hidden), as a written table.

    A file that has gone since it was listed is unreadable; the others are judged.
    """
    readable = path_list(files.where("length > 0 AND NOT hidden"))
    readable = present(spark, readable) if readable else readable
    if readable:
        profiles = profile_files(spark, readable, work)
    else:
        profiles = spark.createDataFrame(
            [],
            "path string, header array<string>, n_rows bigint, multiline boolean, "
            "problems array<string>",
        )
    verdicts = judge_files(files, profiles, run_date, run_id, required)
    verdicts.write.mode("overwrite").parquet(f"{work}/verdicts")
    return spark.read.schema(GATE_LOG).parquet(f"{work}/verdicts")


@dataclass(frozen=True)
class Layout:
    """Judged files of one type and verdict that are read in one way."""

    file_type: str
    verdict: str
    multiline: bool
    paths: list[str]


def layouts(verdicts: DataFrame) -> list[Layout]:
    """File names by layout, for the readers. Only names come to the driver, never rows."""
    found: dict[tuple, Layout] = {}
    judged = verdicts.where(F.col("verdict").isin(VALID, MISSING_COLUMNS, REJECTED_ROWS))
    keys = ("file_type", "verdict", "multiline")
    named = judged.select(*keys, plain_path("path").alias("path"))
    for row in small_rows(named, "path"):
        key = tuple(row[name] for name in keys)
        found.setdefault(key, Layout(*key, [])).paths.append(row["path"])
    return list(found.values())


def in_run(rows: DataFrame, run_date: dt.date, run_id: str) -> DataFrame:
    """Typed rows with the partition columns they are stored by."""
    return rows.withColumns(
        {
            "dt": F.lit(run_date),
            "run_id": F.lit(run_id),
            "order_month": month_of("order_date"),
        }
    )


def append_run(
    rows: DataFrame, path: str, run_date: dt.date, run_id: str, *partitions: str, **options: str
) -> None:
    """Append rows of one run. Its day and id are in the path, so no row carries them through the shuffle and the sort."""
    append(rows.drop("dt", "run_id"), f"{path}/dt={run_date}/run_id={run_id}", *partitions, **options)


def text_rows(
    spark: SparkSession,
    verdicts: DataFrame,
    judged: list[Layout],
    file_type: str,
    columns: list[str],
    work: str,
) -> DataFrame | None:
    """The named columns of the valid files of a type; one scan, and one of the records that `judge` wrote."""
    valid = verdicts.where((F.col("file_type") == file_type) & (F.col("verdict") == VALID))
    reads = [
        read_csv_files(
            spark,
            files.paths,
            valid.where(F.col("multiline") == files.multiline),
            columns,
            records_folder(work) if files.multiline else None,
        )
        for files in judged
        if files.file_type == file_type and files.verdict == VALID
    ]
    return reduce(DataFrame.unionByName, reads) if reads else None


def clean_rows(
    spark: SparkSession,
    verdicts: DataFrame,
    judged: list[Layout],
    file_type: str,
    run_date: dt.date,
    run_id: str,
    work: str,
) -> DataFrame | None:
    """Typed rows of the valid files of a type, as they are stored."""
    raw = text_rows(spark, verdicts, judged, file_type, REQUIRED_COLUMNS[file_type], work)
    if raw is None:
        return None
    return in_run(CLEAN[file_type](raw), run_date, run_id).select(*CLEAN_ROWS[file_type].names)


def archive_files(
    spark: SparkSession,
    workspace: Workspace,
    judged: list[Layout],
    run_date: dt.date,
    run_id: str,
) -> None:
    """Keep the raw lines of every judged file, so that any file can be given back as it came.

    Each type and verdict is written to its own folder straight from its own
    files: no line is shuffled, and none is looked at to learn where it belongs.
    """
    paths: dict[tuple[str, str], list[str]] = {}
    for files in judged:
        paths.setdefault((files.file_type, files.verdict), []).extend(files.paths)
    for (file_type, verdict), names in paths.items():
        folder = f"file_type={file_type}/verdict={verdict}/dt={run_date}/run_id={run_id}"
        lines = read_raw_lines(spark, names)
        lines.write.mode("overwrite").option("compression", "zstd").parquet(f"{workspace.archive}/{folder}")


def file_endings(lines: DataFrame, gate_log: DataFrame) -> DataFrame:
    """(source_file, has_mark, ends_with_break): what the archived lines of a file leave open.

    The lines joined by line feeds are shorter than the file by the length of a
    byte order mark and of a last line feed.
    """
    joined = lines.groupBy("source_file", "run_id").agg(
        (F.sum(F.octet_length("value")) + F.count("*") - 1).alias("_joined")
    )
    log = gate_log.select(F.col("path").alias("source_file"), "run_id", "length")
    rest = F.col("length") - F.col("_joined")
    return joined.join(log, ["source_file", "run_id"]).select(
        "source_file",
        "run_id",
        (rest >= 3).alias("has_mark"),
        (rest % 3 == 1).alias("ends_with_break"),
    )


def list_incoming(
    spark: SparkSession, workspace: Workspace, file_types: Iterable[str] = REQUIRED_COLUMNS
) -> DataFrame:
    """All CSV files of the given types."""
    listings = [
        list_csv_files(spark, workspace.incoming(file_type)).withColumn(
            "file_type", F.lit(file_type)
        )
        for file_type in file_types
    ]
    return reduce(DataFrame.unionByName, listings)


def unjudged(files: DataFrame, gate_log: DataFrame) -> DataFrame:
    """Files without a final verdict; empty and unreadable ones are tried again."""
    judged = gate_log.where(~F.col("verdict").isin(EMPTY, UNREADABLE)).select(
        "path", "modified_at"
    )
    return files.join(judged, ["path", "modified_at"], "left_anti")


def new_arrivals(
    spark: SparkSession, workspace: Workspace, file_types: Iterable[str], work: str
) -> DataFrame:
    """Files to judge, written down so that every step sees the same ones."""
    gate_log = read_table(spark, workspace.gate_log, GATE_LOG)
    files = unjudged(list_incoming(spark, workspace, file_types), gate_log)
    files.write.mode("overwrite").parquet(f"{work}/files")
    return spark.read.parquet(f"{work}/files")


def not_logged(spark: SparkSession, workspace: Workspace, verdicts: DataFrame) -> DataFrame:
    """Verdicts that say something new; empty and unreadable files that stay so are logged once."""
    log = read_table(spark, workspace.gate_log, GATE_LOG)
    known = log.where(F.col("verdict").isin(EMPTY, UNREADABLE)).select("path", "verdict", "length", "modified_at")
    same = ["path", "verdict", "length", "modified_at"]
    alike = reduce(lambda a, b: a & b, [F.col(f"new.{name}").eqNullSafe(F.col(f"old.{name}")) for name in same])
    return verdicts.alias("new").join(known.alias("old"), alike, "left_anti")


def quarantine(spark: SparkSession, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """(files that failed, with what they miss or break; their archived lines)."""
    failed = F.col("verdict").isin(MISSING_COLUMNS, REJECTED_ROWS)
    files = read_table(spark, workspace.gate_log, GATE_LOG).where(failed)
    lines = read_table(spark, workspace.archive, ARCHIVE_LINES).where(failed)
    return files, lines


def run_gate(
    spark: SparkSession,
    workspace: Workspace,
    run_date: dt.date | None = None,
    run_id: str | None = None,
    archive: bool = True,
) -> DataFrame:
    """Judge what is new in the landing folders; return the verdicts of this run.

    The archive costs one more pass over the files. Turn it off where the
    landing folders themselves are kept.
    """
    run_date = run_date or utc_today()
    run_id = run_id or new_run_id()
    work = f"{workspace.staging(run_id)}/gate"
    files = new_arrivals(spark, workspace, REQUIRED_COLUMNS, work)
    verdicts = judge(spark, files, run_date, run_id, work)

    judged = layouts(verdicts)

    def keep_rows(file_type: str) -> None:
        rows = clean_rows(spark, verdicts, judged, file_type, run_date, run_id, work)
        if rows is not None:
            append_run(rows, workspace.clean(file_type), run_date, run_id, "order_month")

    steps = [partial(keep_rows, file_type) for file_type in REQUIRED_COLUMNS]
    if archive:
        steps.append(lambda: archive_files(spark, workspace, judged, run_date, run_id))
    at_once(*steps)
    valid = verdicts.where(F.col("verdict") == VALID)
    write_manifest(valid, workspace.manifests, str(run_date))
    append(not_logged(spark, workspace, verdicts).hint("rebalance"), workspace.gate_log)
    return verdicts
