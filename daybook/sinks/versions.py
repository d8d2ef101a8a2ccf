"""Writing to tables that change by commits, see `daybook.sources.versions`."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from daybook.sinks.tables import even
from daybook.sources.versions import (
    STATES,
    State,
    folder_names,
    hadoop_path,
    is_versioned,
    read_state,
    state_names,
)

COMMITS = "commits"
#: Folders of one partition value whose sizes are alike up to this factor are merged once there are as many.
TIER = 4


class Conflict(PySparkException):
    """Another run has changed the table since its state was read."""


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """A whole file or none: written under a hidden name and then renamed, which fails if `path` is there."""
    folder, name = posixpath.split(path)
    system, draft = hadoop_path(spark, f"{folder}/.{name}.{uuid.uuid4().hex[:8]}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    _, target = hadoop_path(spark, path)
    context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(target), never)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        system.delete(draft, False)
        raise Conflict(f"{path} was written by another run") from error


def write_rows(
    rows: DataFrame,
    path: str,
    version: str,
    partition: str | None = None,
    order: tuple[str, ...] = (),
    **options: int,
) -> dict[str, str]:
    """Writes rows to folders of their own; returns the folder of each partition value ('' without partitions).

    Rows are in order of `order` within a file, so that filters on these columns
    skip parts of it. Nothing counts until a state names the folders.
    """
    spark, folder = rows.sparkSession, f"version={version}"
    if partition is None:
        rows.write.mode("overwrite").options(**options).parquet(f"{path}/{folder}")
        return {"": folder}
    spread = even(rows, partition)
    if order:
        spread = spread.sortWithinPartitions(partition, *order)
    spread.write.mode("overwrite").options(**options).partitionBy(partition).parquet(f"{path}/{folder}")
    names = [n for n in folder_names(spark, f"{path}/{folder}") if n.startswith(f"{partition}=")]
    return {n.partition("=")[2]: f"{folder}/{n}" for n in names}


@dataclass
class Commit:
    """A change of several tables that becomes visible at once."""

    spark: SparkSession
    root: str
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def marker(self) -> str:
        return f"{self.root}/{COMMITS}/{self.name}"

    def prepare(self, path: str, base: State, folders: dict[str, list[str]]) -> None:
        """The table's next state. It counts with the marker."""
        put_state(self.spark, path, base, folders, posixpath.relpath(self.marker, path))

    def append(self, path: str, written: dict[str, str]) -> None:
        """Further folders of their partition values."""
        base = read_state(self.spark, path)
        folders = base.folders | {v: [*base.folders.get(v, ()), f] for v, f in written.items()}
        self.prepare(path, base, folders)

    def finish(self) -> None:
        create_once(self.spark, self.marker, "")


def put_state(
    spark: SparkSession, path: str, base: State, folders: dict[str, list[str]], marker: str | None = None
) -> None:
    content = json.dumps({"marker": marker, "folders": folders}, sort_keys=True)
    create_once(spark, f"{path}/{STATES}/{base.last + 1:09d}.json", content)


def take_over(spark: SparkSession, path: str, schema: StructType, partition: str | None = None) -> None:
    """Gives a plain table, as earlier versions wrote it, its first state; nothing if it has one.

    Folders of partitions move below a version of their own, which a run that
    dies in between leaves to the next. Rows without partitions are copied.
    """
    if is_versioned(spark, path):
        return
    names = [n for n in folder_names(spark, path) if n[0] not in "_." and not n.startswith("version=")]
    first = "version=0"
    if partition is not None:
        for name in names:
            system, source = hadoop_path(spark, f"{path}/{name}")
            _, target = hadoop_path(spark, f"{path}/{first}/{name}")
            system.mkdirs(target.getParent())
            system.rename(source, target)
        moved = [n for n in folder_names(spark, f"{path}/{first}") if n.startswith(f"{partition}=")]
        folders = {n.partition("=")[2]: [f"{first}/{n}"] for n in moved}
    elif names:
        plain = spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names])
        folders = {v: [f] for v, f in write_rows(plain, path, uuid.uuid4().hex).items()}
    else:
        folders = {}
    if folders:
        put_state(spark, path, State(), folders)


def _size(spark: SparkSession, path: str) -> int:
    system, folder = hadoop_path(spark, path)
    return system.getContentSummary(folder).getLength()


def alike(sizes: list[int]) -> list[int]:
    """Places of the folders to merge: `TIER` or more of one tier and all that are smaller; none if all is well.

    Tiers are powers of `TIER`, so a row is rewritten once per tier, and the
    number of folders grows with the logarithm of the rows.
    """
    tiers = [(max(size, 1).bit_length() - 1) // (TIER.bit_length() - 1) for size in sizes]
    full = [t for t in set(tiers) if tiers.count(t) >= TIER]
    return [k for k, t in enumerate(tiers) if t <= max(full)] if full else []


def merge_folders(
    spark: SparkSession,
    path: str,
    merge: Callable[[list[str]], DataFrame],
    partition: str | None = None,
    order: tuple[str, ...] = (),
    **options: int,
) -> bool:
    """Merges small folders of each partition value into one, in a commit of its own; whether there were any.

    `merge` gives the merged rows of some folders. A run that dies here leaves
    the table as it was.
    """
    base = read_state(spark, path)
    chosen = {}
    for value, folders in base.folders.items():
        if len(folders) >= TIER:
            places = alike([_size(spark, f"{path}/{f}") for f in folders])
            if places:
                chosen[value] = [folders[k] for k in places]
    if not chosen:
        return False
    rows = merge([f for folders in chosen.values() for f in folders])
    written = write_rows(rows, path, uuid.uuid4().hex, partition, order, **options)
    merged = dict(base.folders)
    for value, gone in chosen.items():
        rest = [f for f in base.folders[value] if f not in gone]
        merged[value] = [*([written[value]] if value in written else []), *rest]
    put_state(spark, path, base, merged)
    return True


def drop_unused(spark: SparkSession, path: str, keep: int = 3) -> int:
    """Deletes states before the last `keep`, and folders that none of the kept ones names; returns their number.

    For times without a running job: a run may have written folders that it has not committed yet.
    """
    states = state_names(spark, path)
    system, _ = hadoop_path(spark, path)
    used, stream_text = set(), spark._jvm.org.apache.commons.io.IOUtils.toString
    kept = 0
    for name in states:
        _, file = hadoop_path(spark, f"{path}/{STATES}/{name}")
        if kept < keep:
            stream = system.open(file)
            content = json.loads(stream_text(stream, "UTF-8"))
            stream.close()
            marked = content["marker"]
            committed = marked is None or system.exists(hadoop_path(spark, f"{path}/", marked)[1])
            kept += committed
            used |= {f for folders in content["folders"].values() for f in folders if committed}
        else:
            system.delete(file, False)
    gone = 0
    for version in folder_names(spark, path):
        if not version.startswith("version="):
            continue
        below = [n for n in folder_names(spark, f"{path}/{version}") if "=" in n]
        found = [f"{version}/{n}" for n in below] or [version]
        if not any(f in used for f in found):
            found = [version]
        for folder in found:
            if folder not in used:
                system.delete(hadoop_path(spark, f"{path}/{folder}")[1], True)
                gone += 1
    return gone
