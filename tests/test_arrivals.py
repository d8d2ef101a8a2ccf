import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from daybook.operators.arrivals import (
    arrival_summary,
    arrivals,
    parse_notifications,
    start_events,
)
from daybook.sources.notifications import read_notifications
from daybook.streaming.arrivals_stream import stream_start_events
from tests.conftest import as_rows

BUCKET = "shop"


def record(bucket, key):
    found = {"bucket": {"name": bucket}, "object": {"key": key}}
    return {"eventName": "ObjectCreated:Put", "s3": found}


ACCEPTED = {"Records": [record(BUCKET, "incoming/orders/a+b%20c.csv")]}
OTHER_BUCKET = {"Records": [record("other", "incoming/orders/a.csv")]}
OTHER_FOLDER = {"Records": [record(BUCKET, "static/p.csv"), record(BUCKET, "incoming/x.csv")]}
NO_RECORDS = {"Event": "s3:TestEvent"}
NO_KEY = {
    "Records": [
        record(BUCKET, "incoming/first.csv"),
        {"s3": {"bucket": {"name": BUCKET}}},
        record(BUCKET, "incoming/never.csv"),
    ]
}
DOCUMENTS = {
    "accepted": json.dumps(ACCEPTED),
    "other_bucket": json.dumps(OTHER_BUCKET),
    "other_folder": json.dumps(OTHER_FOLDER),
    "no_records": json.dumps(NO_RECORDS),
    "null_records": '{"Records": null}',
    "empty_records": '{"Records": []}',
    "no_key": json.dumps(NO_KEY),
    "not_json": "hello",
    "none": None,
}


@pytest.fixture
def parsed(spark):
    documents = spark.createDataFrame(list(DOCUMENTS.items()), "name string, body string")
    return parse_notifications(documents)


def test_status_codes(parsed):
    assert as_rows(parsed, "name", "status_code") == [
        ("accepted", 200),
        ("empty_records", 200),
        ("no_key", 500),
        ("no_records", 400),
        ("none", 400),
        ("not_json", 400),
        ("null_records", 500),
        ("other_bucket", 200),
        ("other_folder", 200),
    ]


def test_verdicts_and_keys_as_they_come(parsed):
    assert as_rows(arrivals(parsed, BUCKET), "name", "key", "verdict") == [
        ("accepted", "incoming/orders/a+b%20c.csv", "accepted"),
        ("no_key", "incoming/first.csv", "accepted"),
        ("other_bucket", "incoming/orders/a.csv", "skipped"),
        ("other_folder", "incoming/x.csv", "accepted"),
        ("other_folder", "static/p.csv", "skipped"),
    ]


def test_summary(parsed):
    assert as_rows(arrival_summary(parsed, BUCKET), "verdict", "n") == [
        ("accepted", 3),
        ("malformed", 5),
        ("skipped", 2),
    ]


def test_event_fields(parsed):
    at = F.lit(dt.datetime(2025, 7, 6, 9, 8, 7, 123))
    one = start_events(arrivals(parsed, BUCKET).where("name = 'accepted'"), at).first()
    assert json.loads(one["detail"]) == {
        "bucket": BUCKET,
        "key": "incoming/orders/a+b%20c.csv",
        "timestamp": "2025-07-06T09:08:07.000123",
    }
    assert (one["source"], one["detail_type"]) == ("custom.s3.upload", "StartEphemeralPipeline")


def test_event_time_is_utc_in_any_session(spark, parsed):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        at = F.timestamp_seconds(F.lit(1751812687))  # 2025-07-06 14:38:07 UTC
        one = start_events(arrivals(parsed, BUCKET).where("name = 'accepted'"), at).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert one["timestamp"] == "2025-07-06T14:38:07.000000"


def test_stream_emits_each_arrival_once(spark, tmp_path):
    landing, events = tmp_path / "notifications", tmp_path / "events"
    landing.mkdir()

    def run():
        stream_start_events(
            spark, str(landing), str(events), str(tmp_path / "checkpoint"), BUCKET
        ).awaitTermination()
        emitted = spark.read.json(str(events)).collect()
        return sorted(json.loads(row["detail"])["key"] for row in emitted)

    (landing / "1.json").write_text(f"{DOCUMENTS['accepted']}\n{DOCUMENTS['no_records']}\n")
    assert run() == ["incoming/orders/a+b%20c.csv"]
    (landing / "2.json").write_text(DOCUMENTS["other_folder"] + "\n")
    assert run() == ["incoming/orders/a+b%20c.csv", "incoming/x.csv"]
    assert read_notifications(spark, str(landing)).count() == 3
