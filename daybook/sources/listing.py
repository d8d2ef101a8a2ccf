"""A listing of CSV files that tasks read, folder by folder, as a data source."""

import re
import unicodedata
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLITS = 200
ROWS = 10_000

# Signs that the path of a URI holds as they are, beside letters and digits.
_PLAIN = "_-!.~'()*,;:$&+=@/"


def _in_uri(sign: str) -> str:
    if sign.isascii():
        return sign if sign.isalnum() or sign in _PLAIN else quote(sign, safe="")
    return quote(sign) if unicodedata.category(sign) in ("Cc", "Zs", "Zl", "Zp") else sign


def uri_path(path: str) -> str:
    """A plain path as it stands in the URI of a file, in the form that scans report."""
    return "".join(map(_in_uri, path))


def is_hidden(name: str) -> bool:
    """Whether Spark's readers skip files or folders of this name."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


class Folder:
    """A folder of a file system that tasks can open."""

    def __init__(self, scheme: str, authority: str, path: str):
        if scheme == "file":
            self.system, self.base, self.prefix = fs.LocalFileSystem(), "", "file:"
        else:
            known = re.sub("^s3[an]$", "s3", scheme)
            self.system, base = fs.FileSystem.from_uri(f"{known}://{authority}/")
            self.base, self.prefix = base.rstrip("/"), f"{scheme}://{authority}"
        self.path = path.rstrip("/")

    def entries(self, below: str) -> list[fs.FileInfo]:
        """What lies directly in a folder, named from this one; nothing if it has gone."""
        return self.system.get_file_info(fs.FileSelector(self.base + self.path + below, allow_not_found=True))

    def folders(self, below: str) -> list[str]:
        return [f"{below}/{e.base_name}" for e in self.entries(below) if e.type == fs.FileType.Directory]

    def files(self, below: str, deep: bool) -> Iterator[tuple]:
        """(reported path, length, milliseconds, hidden) of CSV files; one folder's entries are held at a time."""
        waiting = [below]
        while waiting:
            at = waiting.pop()
            for entry in self.entries(at):
                name = f"{at}/{entry.base_name}"
                if entry.type == fs.FileType.Directory:
                    waiting += [name] if deep else []
                elif entry.type == fs.FileType.File and name.endswith(".csv"):
                    millis = None if entry.mtime_ns is None else entry.mtime_ns // 1_000_000
                    hidden = any(map(is_hidden, name.split("/")))
                    yield self.prefix + uri_path(self.path + name), entry.size, millis, hidden


class Listed(InputPartition):
    """Folders of one task, each with or without what lies below it."""

    def __init__(self, folders: list[str], deep: bool):
        super().__init__(None)
        self.folders, self.deep = folders, deep


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.where = options["scheme"], options["authority"], options["folder"]
        self.splits = int(options.get("splits", SPLITS))

    def partitions(self) -> list[Listed]:
        """Levels are opened until there are enough folders to share out; names of files are not kept."""
        root = Folder(*self.where)
        opened, level = [], [""]
        while len(level) < self.splits:
            below = [name for at in level for name in root.folders(at)]
            if not below:
                break
            opened, level = opened + level, below
        shared = [(opened, False), (level, True)]
        return [
            Listed(names[k :: self.splits], deep) for names, deep in shared for k in range(min(self.splits, len(names)))
        ]

    def read(self, partition: Listed) -> Iterator[pa.RecordBatch]:
        root = Folder(*self.where)
        rows = []
        for at in partition.folders:
            for row in root.files(at, partition.deep):
                rows.append(row)
                if len(rows) == ROWS:
                    yield _batch(rows)
                    rows = []
        yield _batch(rows)


_COLUMNS = pa.schema([("path", pa.string()), ("length", pa.int64()), ("millis", pa.int64()), ("hidden", pa.bool_())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_COLUMNS)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(values), field.type) for values, field in zip(columns, _COLUMNS)], schema=_COLUMNS
    )


class CsvListing(DataSource):
    """`path, length, millis, hidden` of the CSV files at any depth below a folder.

    Options: `scheme`, `authority` and `folder` of a URI, and `splits`, the number of folders
    from which on no deeper level is opened before tasks start. A folder that is not there has no files.
    """

    @classmethod
    def name(cls) -> str:
        return "csv_listing"

    def schema(self) -> str:
        return "path string, length bigint, millis bigint, hidden boolean"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
