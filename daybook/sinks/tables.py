"""Partitioned Parquet writes."""

from pyspark.sql import DataFrame


def even(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a partition value together, in files of even size.

    Rebalancing is sized at run time: small partitions share a task, and a value
    with a large share of the rows is split over several.
    """
    hint = f"REBALANCE({', '.join(columns)})"
    return df.sparkSession.sql(f"SELECT /*+ {hint} */ * FROM {{rows}}", rows=df)


def append(df: DataFrame, path: str, *partitions: str, **options: str) -> None:
    writer = (even(df, *partitions) if partitions else df).write.mode("append").options(**options)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
