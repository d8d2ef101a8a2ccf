"""Files of token ids that give any token without decoding its neighbours.

An id is split into chunks of one byte, the lowest first. Level 0 holds the
first chunk of every id, level 1 the second chunk of those that have one, and so
on. A bitmap per level marks the chunks that go on, and a rank directory counts
its marks before every 512th, so that a chunk's place in the next level is one
directory entry and at most 512 bits away.

A file is a row of segments with a table of them at its end:

    segment: doc ids (int64), starts (uint64, one more than documents), then for
             each level chunks (uint8), bitmap (uint64 words), directory (uint32);
             the last level has chunks alone; each part is filled up to 8 bytes
    table:   one record of RECORD per segment
    end:     number of segments (uint64), magic (8 bytes)

All numbers are little-endian. A folder's manifest lists its files in order of
the documents, each with the number of ids before it. It is written last, so
files of attempts that failed do not count.
"""

from __future__ import annotations

import bisect
import functools
import json
import math
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from daybook.llm.packing import WordIds
from daybook.llm.rows import id_and_text, text_blocks

FORMAT = "token_files"
MAGIC = b"TOKLVL01"
MANIFEST = "_manifest.json"
LEVELS = 4
#: Bits that one directory entry covers.
BLOCK = 512
RECORD = np.dtype(
    [
        ("offset", "<u8"),
        ("length", "<u8"),
        ("docs", "<u8"),
        ("null_docs", "<u8"),  # these come first, their ids are null
        ("chunks", "<u8", LEVELS),  # of each level; level 0 has one per id
        ("crc32", "<u8"),
    ]
)
DDL = "doc_id long, start long, n_tokens long, ids binary"
SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)


def _filled(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % 8)


def levels_of(ids: np.ndarray) -> tuple[bytes, list[int]]:
    """The levels of some ids as bytes, and the number of chunks of each."""
    parts, counts, rest = [], [], ids.astype(np.uint32)
    while True:
        counts.append(len(rest))
        parts.append(_filled((rest & 0xFF).astype(np.uint8).tobytes()))
        goes_on = rest > 0xFF
        if not goes_on.any():
            return b"".join(parts), counts + [0] * (LEVELS - len(counts))
        bits = np.zeros(-(-len(rest) // BLOCK) * BLOCK // 8, np.uint8)
        packed = np.packbits(goes_on, bitorder="little")
        bits[: len(packed)] = packed
        in_block = np.bitwise_count(bits.view("<u8")).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64)
        parts += [bits.tobytes(), _filled((np.cumsum(in_block) - in_block).astype("<u4").tobytes())]
        rest = rest[goes_on] >> 8


def segment(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bytes of a segment and its record, without the place in the file. Null ids stand first."""
    nulls = sum(d is None for d in doc_ids)
    numbers = np.array([0] * nulls + doc_ids[nulls:], "<i8")
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    raw, counts = levels_of(ids)
    raw = numbers.tobytes() + starts.tobytes() + raw
    record = np.zeros(1, RECORD)
    record[0] = (0, len(raw), len(doc_ids), nulls, counts, zlib.crc32(raw))
    return raw, record


class Segment:
    """Random access to one segment through `read(offset, size)`, offsets from its beginning."""

    def __init__(self, record: np.void, read):
        self.docs, self.null_docs = int(record["docs"]), int(record["null_docs"])
        self.counts = [int(x) for x in record["chunks"]]
        self.read = read
        at, self.places = 8 * (2 * self.docs + 1), []
        for k, n in enumerate(self.counts):
            chunks = at
            bits = chunks + n + -n % 8
            blocks = -(-n // BLOCK)
            directory = bits + blocks * BLOCK // 8
            self.places.append((chunks, bits, directory))
            last = k + 1 == LEVELS or not self.counts[k + 1]
            if last:
                break
            at = directory + 4 * blocks + 4 * (blocks % 2)

    def _marks(self, level: int, a: int, b: int) -> np.ndarray:
        """The bitmap of a level from chunk `a` up to `b`."""
        first = a // 8
        raw = self.read(self.places[level][1] + first, -(-b // 8) - first)
        return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[a - 8 * first : b - 8 * first]

    def _rank(self, level: int, a: int) -> int:
        """Marked chunks of a level before chunk `a`."""
        if a == self.counts[level]:
            return self.counts[level + 1]
        block = a // BLOCK
        before = np.frombuffer(self.read(self.places[level][2] + 4 * block, 4), "<u4")[0]
        return int(before) + int(self._marks(level, block * BLOCK, a).sum() if a % BLOCK else 0)

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids from place `a` up to `b`; reads what they need of each level."""
        out = np.zeros(b - a, np.uint32)
        where = np.arange(b - a)
        for level, (chunks, _, _) in enumerate(self.places):
            if a == b:
                break
            raw = np.frombuffer(self.read(chunks + a, b - a), np.uint8)
            out[where] |= raw.astype(np.uint32) << np.uint32(8 * level)
            if level + 1 < len(self.places):
                goes_on = self._marks(level, a, b).astype(bool)
                a = self._rank(level, a)
                where = where[goes_on]
                b = a + len(where)
        return out

    def documents(self) -> tuple[list, np.ndarray]:
        """The documents' ids, and where each starts, with the end."""
        raw = self.read(0, 8 * (2 * self.docs + 1))
        numbers = np.frombuffer(raw, "<i8", self.docs).tolist()
        numbers[: self.null_docs] = [None] * self.null_docs
        return numbers, np.frombuffer(raw, "<u8", self.docs + 1, 8 * self.docs).astype(np.int64)


class TokenFile:
    """One file, opened for random access."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri} is no file of token ids")
        n = int.from_bytes(tail[:8], "little")
        table = self.file.read_at(n * RECORD.itemsize, size - 16 - n * RECORD.itemsize)
        self.records = np.frombuffer(table, RECORD)
        self.first = [0, *np.cumsum(self.records["chunks"][:, 0].astype(np.int64)).tolist()]

    def close(self) -> None:
        self.file.close()

    def segment(self, k: int) -> Segment:
        begin = int(self.records[k]["offset"])
        return Segment(self.records[k], lambda at, size: self.file.read_at(size, begin + at))

    def whole_segment(self, k: int) -> Segment:
        """The same, read at once and checked."""
        record = self.records[k]
        raw = memoryview(self.file.read_at(int(record["length"]), int(record["offset"])))
        if zlib.crc32(raw) != int(record["crc32"]):
            raise ValueError("a segment of token ids does not match its checksum")
        return Segment(record, lambda at, size: raw[at : at + size])

    def token(self, at: int) -> int:
        """The id at a place in the file."""
        k = bisect.bisect_right(self.first, at) - 1
        return int(self.segment(k).ids(at - self.first[k], at - self.first[k] + 1)[0])


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer: str) -> WordIds:
    """Kept from task to task; a million known words take about 200 MB."""
    return WordIds(tokenizer, room=1_000_000)


@dataclass
class Written(WriterCommitMessage):
    partition: int
    name: str
    docs: int
    ids: int


class _Writer(DataSourceArrowWriter):
    """One file per task: encodes `doc_id, text` in the order of the rows."""

    def __init__(self, folder: str, tokenizer: str, end_id: int, segment_ids: int):
        self.folder, self.tokenizer, self.end_id, self.segment_ids = folder, tokenizer, end_id, segment_ids

    def write(self, iterator) -> Written:
        task, encoder = TaskContext.get(), _encoder(self.tokenizer)
        name = f"part-{task.partitionId():06d}-{uuid.uuid4().hex[:8]}.tok"
        system, root = fs.FileSystem.from_uri(self.folder)
        system.create_dir(root, recursive=True)
        records, docs, total, offset = [], 0, 0, 0
        with system.open_output_stream(f"{root}/{name}") as out:

            def flush():
                nonlocal offset
                raw, record = segment(doc_ids, np.concatenate(lengths), np.concatenate(held))
                record["offset"] = offset
                out.write(raw)
                offset += len(raw)
                records.append(record)

            doc_ids, lengths, held, have = [], [], [], 0
            for rows, data, ends in text_blocks(iterator):
                ids, bounds = encoder.encode(data, ends)
                held.append(np.insert(ids, bounds[1:], self.end_id))
                lengths.append(np.diff(bounds) + 1)
                doc_ids += rows.column("doc_id").to_pylist()
                have += len(held[-1])
                docs, total = docs + rows.num_rows, total + len(held[-1])
                if have >= self.segment_ids:
                    flush()
                    doc_ids, lengths, held, have = [], [], [], 0
            if doc_ids:
                flush()
            out.write(b"".join(r.tobytes() for r in records) + len(records).to_bytes(8, "little") + MAGIC)
        return Written(task.partitionId(), name, docs, total)

    def commit(self, messages) -> None:
        system, root = fs.FileSystem.from_uri(self.folder)
        if system.get_file_info(f"{root}/{MANIFEST}").type != fs.FileType.NotFound:
            raise ValueError(f"{self.folder} holds token ids already")
        files, before = [], 0
        for m in sorted((m for m in messages if m is not None and m.docs), key=lambda m: m.partition):
            files.append({"name": m.name, "docs": m.docs, "ids": m.ids, "before": before})
            before += m.ids
        draft = f"{root}/{MANIFEST}.{uuid.uuid4().hex[:8]}"
        system.create_dir(root, recursive=True)
        with system.open_output_stream(draft) as out:
            out.write(json.dumps({"ids": before, "files": files}).encode())
        system.move(draft, f"{root}/{MANIFEST}")

    def abort(self, messages) -> None:
        """Without a manifest the files count for nothing."""


def manifest(folder: str) -> dict:
    """The files in the order of their documents, each with the ids before it: one entry per writing task."""
    system, root = fs.FileSystem.from_uri(folder)
    with system.open_input_stream(f"{root}/{MANIFEST}") as file:
        return json.loads(file.read())


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [InputPartition((f["name"], f["before"])) for f in manifest(self.folder)["files"]]

    def read(self, partition: InputPartition | None):
        if partition is None:  # no files
            return
        name, before = partition.value
        file = TokenFile(f"{self.folder}/{name}")
        for k in range(len(file.records)):
            part = file.whole_segment(k)
            numbers, starts = part.documents()
            raw = part.ids(0, int(starts[-1])).astype("<u4")
            cells = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), part.docs, [None, pa.py_buffer(4 * starts), pa.py_buffer(raw)]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers, pa.int64()),
                    pa.array(starts[:-1] + (before + file.first[k])),
                    pa.array(np.diff(starts)),
                    cells.cast(pa.binary()),
                ],
                schema=SCHEMA,
            )
        file.close()


class TokenFiles(DataSource):
    """`spark.read.format("token_files").load(folder)`; written with `doc_id, text`, once per folder."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return DDL

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> _Writer:
        o = self.options
        return _Writer(o["path"], o["tokenizer"], int(o.get("end_id", "1")), int(o.get("segment_ids", str(4 << 20))))


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 1,
    file_bytes: int = 256 << 20,
    segment_ids: int = 4 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Writes the ids of all texts, each with `end_id` behind it, to `folder`, in ascending order of the ids.

    There is a file per `file_bytes` of text, two per core at least. One shuffle
    by ranges of the id; rows of one id are ordered by their text's xxhash64 and
    may lie in several files, so an id that holds many rows fills many tasks. A
    task holds a segment of about `segment_ids` ids, or one document.

    A null or empty text is the end id alone. Null ids come first and stay null.
    Repeated rows are written each. No rows give a manifest without files. Other
    columns are ignored. A folder is written once.
    """
    spark = docs.sparkSession
    spark.dataSource.register(TokenFiles)
    texts = id_and_text(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_files = max(2 * spark.sparkContext.defaultParallelism, math.ceil(size / file_bytes))
    # the last key parts rows that are alike
    keyed = texts.withColumns({"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(n_files, "doc_id", "_text", "_row").sortWithinPartitions("doc_id", "_text")
    options = {"tokenizer": tokenizer, "end_id": end_id, "segment_ids": segment_ids}
    ordered.select("doc_id", "text").write.format(FORMAT).options(**options).mode("append").save(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids` per document; `start` counts the ids of all documents before it."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format(FORMAT).load(folder)


def tokens_at(positions: DataFrame, folder: str, position_col: str = "position") -> DataFrame:
    """`position, token` for each row: the id at a place counted over all files, null where there is none.

    Reads a few bytes per level and position. Null positions have no token, repeated rows are answered each.
    """

    def run(batches):
        listed = manifest(folder)
        before = [f["before"] for f in listed["files"]]
        for batch in batches:
            asked, found, opened = batch.column("position").to_pylist(), [None] * batch.num_rows, (None, None)
            for i in sorted(range(len(asked)), key=lambda i: (asked[i] is None, asked[i])):
                if asked[i] is None or not 0 <= asked[i] < listed["ids"]:
                    continue
                k = bisect.bisect_right(before, asked[i]) - 1
                if opened[0] != k:
                    if opened[1]:
                        opened[1].close()
                    opened = k, TokenFile(f"{folder}/{listed['files'][k]['name']}")
                found[i] = opened[1].token(asked[i] - before[k])
            if opened[1]:
                opened[1].close()
            yield pa.RecordBatch.from_arrays(
                [batch.column("position"), pa.array(found, pa.int64())], names=["position", "token"]
            )

    wanted = positions.select(F.col(position_col).cast("long").alias("position"))
    return wanted.mapInArrow(run, "position long, token long")
