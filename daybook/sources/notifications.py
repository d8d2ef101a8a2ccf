"""Reading object-created notifications, one JSON document per line."""

from pyspark.sql import DataFrame, SparkSession


def read_notifications(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "body")


def stream_notifications(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return spark.readStream.options(**options).text(path).withColumnRenamed("value", "body")
