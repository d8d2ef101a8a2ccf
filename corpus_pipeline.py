"""A corpus pipeline: five operators, each on what the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import decontamination, packing, quality, simhash, substring_dedup
from daybook.llm.rows import held_out, read_table
from daybook.session import scratch_folder

#: Learned scores, SimHash by XXH64 and token ids are beyond SQL.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    return docs.where(quality.score_column(docs, model) >= 0.3)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 3-word shingles, 3 bits."""
    return simhash.one_per_group(docs, shingle=3, distance=3)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 35-word passages that start more than once."""
    cut = substring_dedup.cut_repeats(docs, window=35)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"), similarity=0.8)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=2048, end_id=1)


STAGES = [
    ("quality classifier", good_documents),
    ("SimHash near-dedup", one_of_near_copies),
    ("substring dedup", without_repeated_passages),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage is written to the shared folder and read again by the next."""
    folder = f"{scratch_folder(spark, 'pipeline')}/{uuid.uuid4().hex[:8]}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
