"""From object-created notifications to pipeline-start events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.schemas import EVENT_DETAIL_TYPE, EVENT_SOURCE, INCOMING, NOTIFICATION

ACCEPTED = "accepted"
SKIPPED = "skipped"
MALFORMED = "malformed"


def _is_whole(record: Column) -> Column:
    return record["s3"]["bucket"]["name"].isNotNull() & record["s3"]["object"]["key"].isNotNull()


def _verdict(record: Column, bucket: str, prefix: str) -> Column:
    wanted = (record["s3"]["bucket"]["name"] == bucket) & F.startswith(
        record["s3"]["object"]["key"], F.lit(prefix)
    )
    return F.when(wanted, ACCEPTED).otherwise(SKIPPED)


def parse_notifications(documents: DataFrame, body: str = "body") -> DataFrame:
    """Add `records` up to the first incomplete one, and `status_code`.

    400: the document has no `Records`. 500: a record lacks its bucket or key;
    records before it still count, later ones do not. 200: everything else.
    """
    records = F.from_json(F.col(body), NOTIFICATION)["Records"]
    incomplete = F.array_position(F.transform("_all", _is_whole), F.lit(False))
    has_records = F.array_contains(F.json_object_keys(body), "Records")
    return (
        documents.withColumn("_all", records)
        .withColumn("_incomplete", F.coalesce(incomplete, F.lit(0)))
        .withColumn(
            "records",
            F.when(
                F.col("_incomplete") > 0,
                F.slice("_all", F.lit(1), F.col("_incomplete").cast("int") - 1),
            ).otherwise(F.col("_all")),
        )
        .withColumn(
            "status_code",
            F.when(~F.coalesce(has_records, F.lit(False)), 400)
            .when(F.col("_all").isNull() | (F.col("_incomplete") > 0), 500)
            .otherwise(200),
        )
        .drop("_all", "_incomplete")
    )


def arrivals(parsed: DataFrame, bucket: str, prefix: str = INCOMING) -> DataFrame:
    """One row per record with `bucket`, `key` and the verdict accepted or skipped.

    The outer form keeps Spark from parsing every document a second time, to
    drop those without records.
    """
    kept = [name for name in parsed.columns if name not in ("records", "body")]
    return (
        parsed.select(*kept, F.explode_outer("records").alias("record"))
        .where("record IS NOT NULL")
        .select(
            *kept,
            F.col("record.s3.bucket.name").alias("bucket"),
            F.col("record.s3.object.key").alias("key"),
            _verdict(F.col("record"), bucket, prefix).alias("verdict"),
        )
    )


def start_events(arrived: DataFrame, emitted_at: Column | None = None) -> DataFrame:
    """The event of each accepted arrival: its fields and its JSON `detail`.

    The time is in UTC, whatever the zone of the session.
    """
    emitted_at = F.current_timestamp() if emitted_at is None else emitted_at
    in_utc = F.convert_timezone(None, F.lit("UTC"), emitted_at)
    timestamp = F.date_format(in_utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return (
        arrived.where(F.col("verdict") == ACCEPTED)
        .withColumn("timestamp", timestamp)
        .withColumn("source", F.lit(EVENT_SOURCE))
        .withColumn("detail_type", F.lit(EVENT_DETAIL_TYPE))
        .withColumn("detail", F.to_json(F.struct("bucket", "key", "timestamp")))
    )


def arrival_summary(parsed: DataFrame, bucket: str, prefix: str = INCOMING) -> DataFrame:
    """Accepted and skipped records and malformed documents of a batch."""
    verdicts = F.concat(
        F.coalesce(
            F.transform("records", lambda record: _verdict(record, bucket, prefix)),
            F.array().cast("array<string>"),
        ),
        F.when(F.col("status_code") != 200, F.array(F.lit(MALFORMED))).otherwise(
            F.array().cast("array<string>")
        ),
    )
    return (
        parsed.select(F.explode_outer(verdicts).alias("verdict"))
        .where("verdict IS NOT NULL")
        .groupBy("verdict")
        .agg(F.count("*").alias("n"))
    )
