"""Lists of labels per row."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def labels_where(conditions: Iterable[tuple[str, Column]]) -> Column:
    """Array of the labels whose condition holds, in the given order.

    Built by dropping empty names, which stays in generated code; a filter with
    a lambda would be interpreted row by row.
    """
    names = [F.when(holds, F.lit(label)).otherwise(F.lit("")) for label, holds in conditions]
    return F.array_remove(F.array(*names), "")
