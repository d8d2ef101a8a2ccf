"""Helpers that every text operator shares: input columns, blocks of text, scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import scratch_folder

#: Text that one step of a Python task handles at once.
BLOCK_BYTES = 4 << 20
#: Bytes that a partition of a shuffle may hold before there are more partitions than Spark is set to.
PARTITION_BYTES = 64 << 20


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` and `text` alone, so that no other column can clash; a null text is empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def id_and_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Columns that tell documents apart also where ids repeat: the id and the text's xxhash64."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest")]


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id is in no fold."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def held_out(doc_id: Column | str) -> Column:
    """Whether the row is in fold 0, which nothing learns from; a null id is held out."""
    return F.coalesce(fold(doc_id) == 0, F.lit(True))


def uniform(column: Column | str) -> Column:
    """A repeatable number from 0 up to 1 for a value, used to take bounded samples."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 30)) / F.lit(float(1 << 30))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to a new folder below the shared scratch folder, and read again.

    This cuts the lineage: executors lost later cost only a read.
    """
    spark = df.sparkSession
    folder = f"{scratch_folder(spark, purpose)}/{uuid.uuid4().hex[:8]}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def partitions_for(spark: SparkSession, n_bytes: int) -> int:
    """Partitions of a shuffle of `n_bytes`: as many as Spark is set to, more where they would be too large."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // PARTITION_BYTES))


def spread(df: DataFrame, parts: int, column: str) -> DataFrame:
    """Rows by a column in `parts` partitions; Spark may merge them where that is its own number."""
    own = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, column) if parts > own else df.repartition(column)


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows, without a copy. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def text_blocks(
    batches: Iterable[pa.RecordBatch], size: int = BLOCK_BYTES, text: str = "text"
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in blocks of about `size` bytes of text, one row at least: (rows, bytes, offsets)."""
    held: list[pa.RecordBatch] = []
    have = 0
    for batch in batches:
        data, ends = string_buffers(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + (size - have), side="right")) - 1
            to = min(max(to, at + (not held)), batch.num_rows)
            if to > at:
                held.append(batch.slice(at, to - at))
                have += int(ends[to] - ends[at])
            if to < batch.num_rows:  # the same cuts however the rows are batched
                yield _joined(held, text)
                held, have = [], 0
            at = to
    if held:
        yield _joined(held, text)


def _joined(held: list[pa.RecordBatch], text: str):
    rows = held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return (rows, *string_buffers(rows.column(text)))
