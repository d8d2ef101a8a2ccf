"""Reading CSV files whose columns may come in any order."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.joins import join_on_key
from daybook.sources.files import literal_paths, stored_records


def read_csv_files(
    spark: SparkSession,
    paths: list[str],
    files: DataFrame,
    columns: list[str],
    records: str | None = None,
) -> DataFrame | None:
    """The named columns, as text, of files with any headers, in one scan; None without files.

    `files` has (path, header) of the files at `paths`. One CSV read gives all
    its files the same columns by position. Where all headers have the wanted
    columns at the same places, these are the columns read. Else the fields of a
    row become an array, and its file says at which places of it they are.
    Files with quoted line breaks come from the folder `records` that
    `write_records` filled.
    """
    places = files.select(
        F.col("path").alias("source_file"),
        F.array(*[F.array_position("header", name).cast("int") for name in columns]).alias("_places"),
    )
    least, most, width = places.agg(
        F.min("_places"), F.max("_places"), F.max(F.array_max("_places"))
    ).first()
    if not paths or width is None:
        return None
    rows = _records(spark, records, files, width) if records else _lines(spark, paths, width)
    if least == most:
        return rows.select(
            *[F.col(f"c{at - 1}").alias(name) for name, at in zip(columns, most)], "source_file"
        )
    fields = rows.select(F.array(*[f"c{k}" for k in range(width)]).alias("_fields"), "source_file")
    return join_on_key(fields, places, "source_file", "inner").select(
        *[F.get("_fields", F.col("_places")[k] - 1).alias(name) for k, name in enumerate(columns)],
        "source_file",
    )


def _lines(spark: SparkSession, paths: list[str], width: int) -> DataFrame:
    """c0, c1, ... and source_file of the rows of files, without their headers."""
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(width)])
    reader = spark.read.option("header", True).option("escape", '"')
    return reader.schema(schema).csv(literal_paths(paths)).select(
        *schema.names, F.col("_metadata.file_path").alias("source_file")
    )


def _records(spark: SparkSession, folder: str, files: DataFrame, width: int) -> DataFrame:
    """The same of those files whose records are in a folder."""
    records = stored_records(spark, folder)
    at = F.struct("block_start", "line_id")
    first = records.groupBy("path").agg(F.min(at).alias("_first")).join(files.select("path"), "path")
    rows = join_on_key(records, first, "path", "inner").where(at > F.col("_first"))
    schema = ", ".join(f"c{k} string" for k in range(width))
    parsed = F.from_csv("value", schema, {"escape": '"'})
    return rows.select(parsed.alias("_row"), "path").select("_row.*", F.col("path").alias("source_file"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file, or all those of a folder, with a header row; every column is text."""
    reader = spark.read.option("header", True).option("escape", '"')
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    return reader.csv(literal_paths([path]))
