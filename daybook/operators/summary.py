"""Row counts of the outputs of a run."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_summary(outputs: dict[str, DataFrame]) -> DataFrame:
    """(output, n_rows), one row per named output."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("output"), "n_rows")
        for name, df in outputs.items()
    ]
    return reduce(DataFrame.unionByName, counts)
