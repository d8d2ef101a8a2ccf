"""Notifications in, pipeline-start events out, as files arrive."""

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from daybook.operators.arrivals import arrivals, parse_notifications, start_events
from daybook.schemas import INCOMING
from daybook.sources.notifications import stream_notifications


def stream_start_events(
    spark: SparkSession,
    notifications: str,
    events: str,
    checkpoint: str,
    bucket: str,
    prefix: str = INCOMING,
) -> StreamingQuery:
    """Write one JSON event per accepted record; no state, no shuffle."""
    arrived = arrivals(
        parse_notifications(stream_notifications(spark, notifications)), bucket, prefix
    )
    return (
        start_events(arrived)
        .select("source", "detail_type", "detail")
        .writeStream.format("json")
        .option("path", events)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
