"""Tables that change by commits only.

The rows of a table lie in folders that are never touched again once they are
written, `version=<id>/` with one folder per partition value below. A small
state file names the folders that count, by partition value. Readers take the
newest state that is committed, so they see a whole change or nothing of it.

A state that belongs to a change of several tables names a marker file. It
counts once that file is there; creating it commits all of them at once.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

STATES = "_states"
#: The partition value of rows that have none, as Spark names their folder.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class State:
    """The folders of each partition value, oldest first; `last` is the highest number taken, committed or not."""

    last: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)


def hadoop_path(spark: SparkSession, *parts: str):
    """(file system, path); later parts are resolved against the one before."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    path = path_of(parts[0])
    for part in parts[1:]:
        path = path_of(path, part)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, at = hadoop_path(spark, path)
    return system.exists(at)


def no_rows(rows: DataFrame) -> DataFrame:
    """The columns of `rows` alone. Joins with it are decided before they run, unlike with an empty list of rows."""
    return rows.limit(0)


def read_partitions(
    spark: SparkSession, path: str, schema: StructType, partitions: list[str]
) -> DataFrame:
    """Only the named partition folders are listed and read."""
    if not partitions:
        return no_rows(spark.createDataFrame([], schema))
    folders = [f"{path}/{partition}" for partition in partitions]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it is not there."""
    if not path_exists(spark, path):
        return []
    system, folder = hadoop_path(spark, path)
    return [entry.getPath().getName() for entry in system.listStatus(folder)]


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(state_names(spark, path))


def state_names(spark: SparkSession, path: str) -> list[str]:
    """State files, the newest first. Drafts are hidden."""
    names = folder_names(spark, f"{path}/{STATES}")
    return sorted((n for n in names if n.endswith(".json") and n[0] != "."), reverse=True)


def read_state(spark: SparkSession, path: str) -> State:
    """The newest committed state."""
    names = state_names(spark, path)
    last = int(names[0].removesuffix(".json")) if names else 0
    for name in names:
        system, file = hadoop_path(spark, f"{path}/{STATES}/{name}")
        stream = system.open(file)
        try:
            content = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if content["marker"] is not None:
            marked, marker = hadoop_path(spark, f"{path}/", content["marker"])
            if not marked.exists(marker):
                continue
        return State(last, content["folders"])
    return State(last)


def read_folders(
    spark: SparkSession, path: str, schema: StructType, folders: Iterable[str]
) -> DataFrame:
    return read_partitions(spark, path, schema, list(folders)).select(*schema.names)


def read_versions(
    spark: SparkSession,
    path: str,
    schema: StructType,
    values: Iterable[str] | None = None,
    more: dict[str, str] | None = None,
) -> DataFrame:
    """Rows of the committed state, of some partition values or all.

    `more` adds folders by partition value that are written but not committed.
    """
    state, more = read_state(spark, path).folders, more or {}
    wanted = sorted({*state, *more} if values is None else {*values} & {*state, *more})
    folders = [f for value in wanted for f in state.get(value, ())]
    folders += [more[value] for value in wanted if value in more]
    return read_folders(spark, path, schema, folders)
