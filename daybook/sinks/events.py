"""Writing pipeline-start events."""

from pyspark.sql import DataFrame


def write_events(events: DataFrame, path: str) -> None:
    """Append one JSON line per event."""
    events.select("source", "detail_type", "detail").write.mode("append").json(path)
