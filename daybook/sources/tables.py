"""Reading Parquet tables, with an empty table where none was written yet."""

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

from daybook.operators.ledger import distinct_ledger
from daybook.schemas import LEDGER
from daybook.sources.versions import is_versioned, path_exists, read_partitions, read_versions

__all__ = ["path_exists", "read_ledger", "read_partitions", "read_table", "small_rows"]


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A plain table, or the committed rows of one that changes by commits."""
    if is_versioned(spark, path):
        return read_versions(spark, path, schema)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def small_rows(df: DataFrame, *order: str) -> Iterator[Row]:
    """Rows of a small result the driver needs, in an order if asked: file names, gate runs, days, months.

    One partition, as the iterator starts a job for each. The rows move there; what
    they come from, a listing or a scan, runs in tasks of its own.
    """
    one = df.repartition(1)
    return (one.sortWithinPartitions(*order) if order else one).toLocalIterator()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return distinct_ledger(read_table(spark, path, LEDGER))
