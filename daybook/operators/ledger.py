"""Which files still have to be processed."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.schemas import FILE_IDENTITY


def new_files(
    files: DataFrame, ledger: DataFrame, identity: Sequence[str] = FILE_IDENTITY
) -> DataFrame:
    """Listed CSV files that the ledger does not know."""
    csv = files.where(F.endswith("file_key", F.lit(".csv")))
    return csv.join(ledger.select(*identity), list(identity), "left_anti")


def latest_file_per_type(files: DataFrame) -> DataFrame:
    """The last key of each type in text order, and how many files wait."""
    return files.groupBy("file_type").agg(
        F.max("file_key").alias("latest_key"),
        F.count("*").alias("pending"),
    )


def latest_files(files: DataFrame) -> DataFrame:
    """One file of each type: that of the last key, the last to come of equal keys."""
    last = files.groupBy("file_type").agg(
        F.max(F.struct("file_key", "modified_at", "path")).alias("last")
    )
    return last.select("file_type", "last.*")


def distinct_ledger(entries: DataFrame) -> DataFrame:
    """One row per file; a file marked twice keeps its last time."""
    return entries.groupBy(*FILE_IDENTITY, "file_key").agg(
        F.max("processed_at").alias("processed_at")
    )
