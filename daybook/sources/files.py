"""File listings and the lines and records of text files."""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.records import (
    OPEN_QUOTE,
    RECORD_BYTES,
    TOO_LONG,
    assemble_records,
    block_states,
    unfinished_files,
)
from daybook.sources.listing import SPLITS, CsvListing
from daybook.sources.tables import path_exists


def list_csv_files(spark: SparkSession, folder: str, splits: int = SPLITS) -> DataFrame:
    """(path, length, modified_at, hidden) of every `.csv` file at any depth below a folder.

    Tasks list the folders, so no name comes to the driver. Paths are in the
    form in which a scan reports them, see `reported_path`. Only file status is
    read. Files that readers skip because their name or that of a folder starts
    with `_` or `.` are `hidden`.
    """
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    system = path_of(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(path_of(folder)).toUri()
    spark.dataSource.register(CsvListing)
    listed = (
        spark.read.format("csv_listing")
        .option("scheme", uri.getScheme())
        .option("authority", uri.getAuthority() or "")
        .option("folder", uri.getPath())
        .option("splits", splits)
        .load()
    )
    return listed.select("path", "length", F.timestamp_millis("millis").alias("modified_at"), "hidden")


def latest_delivery(spark: SparkSession, folder: str) -> str:
    """The last entry of a folder in text order that holds CSV files: a file, or a folder with all its files."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    system = path_of(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    names = []
    if path_exists(spark, folder):
        entries = system.listStatus(path_of(folder))
        names = sorted((e.getPath().getName() for e in entries), reverse=True)
    for name in names:
        entry = f"{folder.rstrip('/')}/{name}"
        if name[0] not in "_." and not _no_csv(spark, entry):
            return entry
    raise FileNotFoundError(f"no product files found in {folder}")


def _no_csv(spark: SparkSession, entry: str) -> bool:
    filled = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(literal_paths([entry])[0])
    )
    return filled.select("length").isEmpty()


def literal_paths(paths: list[str]) -> list[str]:
    """Escape characters that Spark would read as a glob pattern."""
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for path in paths]


def present(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that are still there. Each is asked for only if a reader misses one."""
    try:
        spark.read.text(literal_paths(paths))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return [path for path in paths if path_exists(spark, path)]
    return paths


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, block_start, line_id, value) of every line that is not blank.

    Files are split, so `(block_start, line_id)` orders the lines of a file. A
    file that vanishes meanwhile has no lines.
    """
    return (
        spark.read.option("ignoreMissingFiles", True)
        .text(literal_paths(paths))
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            "value",
        )
        .where(F.trim("value") != "")
        .withColumn("line_id", F.monotonically_increasing_id())
    )


def read_raw_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_file, block_start, line_id, value) of all that stands between line feeds.

    Blank lines and carriage returns stay, so the lines of a file in order,
    joined by line feeds, are its bytes; a byte order mark and whether the last
    line ends with a line feed follow from the file's length.
    """
    return (
        spark.read.option("lineSep", "\n")
        .text(literal_paths(paths))
        .select(
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("line_id"),
            "value",
        )
    )


def read_all_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Like `read_lines`, with blank lines, which may be part of a quoted field."""
    return (
        spark.read.option("ignoreMissingFiles", True)
        .text(literal_paths(paths))
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("line_id"),
            "value",
        )
    )


def write_records(spark: SparkSession, paths: list[str], folder: str, limit: int = RECORD_BYTES) -> None:
    """Write the records of files with quoted line breaks to a folder, for `stored_records` and `record_problems`.

    Files are read in splits like any other, twice: once for the states of their
    blocks, once for the records. Whatever needs records reads them from here.
    """
    lines = read_all_lines(spark, paths)
    block_states(lines).write.mode("overwrite").parquet(f"{folder}/states")
    records = assemble_records(lines, spark.read.parquet(f"{folder}/states"), limit)
    records.write.mode("overwrite").parquet(f"{folder}/records")


def stored_records(spark: SparkSession, folder: str) -> DataFrame:
    """Like `read_lines`, with quoted line breaks kept inside one record; no records that are too long."""
    return spark.read.parquet(f"{folder}/records").where(F.trim("value") != "")


def record_problems(spark: SparkSession, folder: str) -> DataFrame:
    """(path, found): files that end inside a quoted field or hold a record that is too long."""
    opened = unfinished_files(spark.read.parquet(f"{folder}/states")).withColumn("found", F.lit(OPEN_QUOTE))
    long = spark.read.parquet(f"{folder}/records").where("value IS NULL").select("path").distinct()
    return (
        opened.unionByName(long.withColumn("found", F.lit(TOO_LONG)))
        .groupBy("path")
        .agg(F.sort_array(F.collect_set("found")).alias("found"))
    )
