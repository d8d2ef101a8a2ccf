"""Token counts through a cache of digests.

Content is identified by the SHA-256 of its UTF-8 bytes, a tokenizer by the
SHA-256 of its file. Stored counts are joined by both. Only distinct contents
without a stored count are encoded, and their counts are appended to the cache.
"""

from __future__ import annotations

import functools
import hashlib
import pathlib

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import id_and_text, text_blocks
from daybook.operators.joins import join_on_key

CACHE = T.StructType(
    [
        T.StructField("tokenizer", T.StringType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)


def file_digest(path: str) -> str:
    return hashlib.sha256(pathlib.Path(path).read_bytes()).hexdigest()


@functools.lru_cache(maxsize=4)
def _encoder(path: str):
    """texts -> numbers of tokens, as the file's library gives them, without special tokens added."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    words = Tokenizer.from_file(path)
    words.no_truncation()
    words.no_padding()
    return lambda texts: [len(x.ids) for x in words.encode_batch_fast(texts, add_special_tokens=False)]


def _local_distinct(batches):
    """Compressed texts by digest, each once per task and block, so that no group of copies is moved whole."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    schema = pa.schema([("digest", pa.binary()), ("packed", pa.binary())])
    for rows, _, _ in text_blocks(batches, size=16 << 20):
        found = {}
        for text in rows.column("text").to_pylist():
            raw = text.encode()
            found.setdefault(hashlib.sha256(raw).digest(), raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array([squeeze(x) for x in found.values()], pa.binary())],
            schema=schema,
        )


def _encode(path: str, version: str):
    def run(batches):
        counts, seen = _encoder(path), set()
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            digests, packed = batch.column("digest").to_pylist(), batch.column("packed")
            fresh, texts, size = [], [], 0
            for i, digest in enumerate(digests):
                if digest not in seen:
                    seen.add(digest)
                    fresh.append(digest)
                    texts.append(unpack(packed[i].as_py()).decode())
                    size += len(texts[-1])
                if texts and (size > 1 << 20 or i + 1 == len(digests)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([version] * len(fresh), pa.string()),
                            pa.array(fresh, pa.binary()),
                            pa.array(counts(texts), pa.int64()),
                        ],
                        schema=pa.schema(
                            [("tokenizer", pa.string()), ("digest", pa.binary()), ("n_tokens", pa.int64())]
                        ),
                    )
                    fresh, texts, size = [], [], 0

    return run


def stored_counts(spark, cache: str, version: str) -> DataFrame:
    """Counts of a tokenizer, one row per digest also where two runs appended the same content."""
    try:
        stored = spark.read.schema(CACHE).parquet(cache)
    except Exception as error:  # the first run finds no folder
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = spark.createDataFrame([], CACHE)
    return stored.where(F.col("tokenizer") == version).groupBy("digest").agg(
        F.max("n_tokens").alias("n_tokens")
    )


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` per row of `docs`; appends to the table in `cache`.

    A null text is empty and has 0 tokens. Rows that repeat are answered each.
    A null id stays null. No rows give no rows. Other columns are ignored.
    Tasks hold the digests of their share of the misses, 32 bytes each.
    """
    spark = docs.sparkSession
    version = file_digest(tokenizer)
    texts = id_and_text(docs, id_col, text_col)
    distinct = texts.select("text").mapInArrow(
        _local_distinct, "digest binary, packed binary"
    ).repartition("digest")
    misses = distinct.join(stored_counts(spark, cache, version), "digest", "left_anti")
    misses.mapInArrow(_encode(tokenizer, version), CACHE).write.mode("append").parquet(cache)
    keyed = texts.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )
    # copies of one text may be a third of all rows; this join splits them
    return join_on_key(keyed, stored_counts(spark, cache, version), "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
