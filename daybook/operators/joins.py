"""Joins that stay even when one key holds a large share of the left rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_key(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join on one column with both sides shuffled for this join.

    For a right side that is already partitioned by `key`, such as an aggregate
    by it. Joined on that column alone Spark would reuse that partitioning, and
    adaptive execution only splits a hot partition when both inputs are shuffled
    for the join itself. The second key follows from the first, so it changes no
    match; it only asks for that shuffle. A small right side is still broadcast,
    by Spark's own size threshold.
    """
    key_type = left.schema[key].dataType
    if right.schema[key].dataType != key_type:
        right = right.withColumn(key, F.col(key).try_cast(key_type))
    spread = F.pmod(F.hash(key), F.lit(2))
    return (
        left.withColumn("_spread", spread)
        .join(right.withColumn("_spread", spread), [key, "_spread"], how)
        .drop("_spread")
    )
