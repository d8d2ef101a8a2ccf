"""A batch of notifications: events of the accepted records, and a count of the rest."""

from pyspark.sql import DataFrame, SparkSession

from daybook.operators.arrivals import (
    arrival_summary,
    arrivals,
    parse_notifications,
    start_events,
)
from daybook.schemas import INCOMING
from daybook.sinks.events import write_events
from daybook.sources.notifications import read_notifications


def run_arrivals(
    spark: SparkSession, notifications: str, events: str, bucket: str, prefix: str = INCOMING
) -> DataFrame:
    """Write the start events; return the summary of the batch."""
    parsed = parse_notifications(read_notifications(spark, notifications))
    write_events(start_events(arrivals(parsed, bucket, prefix)), events)
    return arrival_summary(parsed, bucket, prefix)
