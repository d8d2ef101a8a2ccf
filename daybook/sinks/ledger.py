"""The ledger of processed files."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.ledger import distinct_ledger
from daybook.schemas import LEDGER
from daybook.sinks.versions import Commit, merge_folders, put_state, take_over, write_rows
from daybook.sources.versions import read_folders, read_state


def mark_processed(files: DataFrame, path: str, processed_at=None, commit: Commit | None = None) -> None:
    """Add identity and key of each file with the time it was processed, at once or with a commit."""
    spark = files.sparkSession
    processed_at = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    entries = files.withColumn("processed_at", processed_at.cast("timestamp")).select(*LEDGER.names)
    take_over(spark, path, LEDGER)
    written = write_rows(entries.hint("rebalance"), path, uuid.uuid4().hex)
    if commit is not None:
        commit.append(path, written)
        return
    base = read_state(spark, path)
    put_state(spark, path, base, {"": [*base.folders.get("", ()), written[""]]})


def compact_ledger(spark: SparkSession, path: str) -> bool:
    """Merge small runs of entries, so that their number grows with the logarithm of the files."""

    def merge(folders: list[str]) -> DataFrame:
        return distinct_ledger(read_folders(spark, path, LEDGER, folders)).select(*LEDGER.names)

    return merge_folders(spark, path, merge)
