"""Quality scores by compression.

Two zstandard dictionaries are built, one from labelled good text and one from
bad. A text is compressed piece by piece with both; the normalised difference of
the sizes says which it resembles. A logistic curve over it, and over how well
the text compresses at all for its length, is fitted on texts that the
dictionaries have not seen and makes it a probability.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import text_blocks, uniform

PIECE = 512
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # of the measures, and an offset


@functools.lru_cache(maxsize=8)
def _compressor(content: bytes):
    if not content:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False).compress
    held = zstandard.ZstdCompressionDict(content)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_dict_id=False).compress


def measures(model: QualityModel, text: bytes) -> np.ndarray:
    """The difference of the sizes with both dictionaries, normalised by the text and by the sizes,
    how well each dictionary compresses, and the length."""
    good, bad = _compressor(model.good), _compressor(model.bad)
    as_good = as_bad = 0
    for at in range(0, len(text), PIECE):
        piece = text[at : at + PIECE]
        as_good += len(good(piece))
        as_bad += len(bad(piece))
    n = max(len(text), 1)
    return np.array(
        [
            (as_bad - as_good) / n,
            (as_bad - as_good) / (as_bad + as_good + 1),
            np.log((as_good + 8) / n),
            np.log((as_bad + 8) / n),
            np.log(n + 16),
        ]
    )


MEASURES = 5


def score(model: QualityModel, text: bytes) -> float:
    *weights, offset = model.weights
    value = float(np.dot(weights, measures(model, text))) + offset
    return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the plain end of the texts where there are too few to train on."""
    pieces = [t[a : a + PIECE] for t in texts for a in range(0, len(t), PIECE)]
    total = sum(map(len, pieces))
    if len(pieces) >= 64 and total >= 4 * 1024:
        try:
            return zstandard.train_dictionary(min(size, max(1024, total // 4)), pieces, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # texts that are all alike
            pass
    return b"\n".join(texts)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and offset by Newton's method, with a little weight against extremes."""
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    features = np.c_[(x - middle) / spread, np.ones(len(x))]
    w = np.zeros(features.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        hessian = (features * (p * (1 - p))[:, None]).T @ features + 1e-2 * np.eye(len(w))
        change = np.linalg.solve(hessian, features.T @ (y - p) - 1e-2 * w)
        w += change
        if np.abs(change).max() < 1e-9:
            break
    plain = w[:-1] / spread
    return np.append(plain, w[-1] - plain @ middle)


def fit(good: list[bytes], bad: list[bytes], size: int = 64 << 10, odds: float | None = None) -> QualityModel:
    """Dictionaries from two thirds of the texts, the curve from the last third.

    `odds` is the number of good for each bad document where the texts were
    taken from; the curve is shifted to it from the odds of the texts given.
    Without texts of one kind the score is the share of good texts, 0.5 without any.
    """
    if not good or not bad:
        share = (len(good) + 1) / (len(good) + len(bad) + 2) if good or bad else 0.5
        return QualityModel(b"", b"", (0.0,) * MEASURES + (float(np.log(share / (1 - share))),))

    def split(texts):
        return [t for k, t in enumerate(texts) if k % 3], [
            t for k, t in enumerate(texts) if k % 3 == 0
        ] or texts

    (learn_good, check_good), (learn_bad, check_bad) = split(good), split(bad)
    learned = _dictionary(learn_good or good, size), _dictionary(learn_bad or bad, size)
    first = QualityModel(*learned, ())
    x = np.array([measures(first, t) for t in check_good + check_bad])
    y = np.array([1.0] * len(check_good) + [0.0] * len(check_bad))
    weights = _logistic(x, y)
    if odds:
        weights[-1] += np.log(odds / (y.sum() / (len(y) - y.sum())))
    return QualityModel(*learned, tuple(weights.tolist()))


def train(
    docs: DataFrame, labels: DataFrame, per_class: int = 1500, excerpt: int = 4096, size: int = 64 << 10,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> QualityModel:
    """A model of labelled rows, at most about `per_class` of each label, chosen by a hash of the id.

    A document with several labels has the larger share of them, ties count as
    good. Null ids and labels teach nothing. Excerpts bound the texts that reach
    the driver, in training alone; scores take whole texts.
    """
    marked = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label"))
        .where("id is not null and label is not null")
        .groupBy("id")
        .agg((F.avg("label") >= 0.5).alias("good"))
    )
    counts = {r["good"]: r["n"] for r in marked.groupBy("good").agg(F.count("*").alias("n")).collect()}
    share = F.when(
        F.col("good"), min(1.0, per_class / counts.get(True, 1))
    ).otherwise(min(1.0, per_class / counts.get(False, 1)))
    few = marked.where(uniform("id") < share).limit(3 * per_class)
    rows = (
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.substring(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 1, excerpt).alias("text"),
        )
        .join(F.broadcast(few), "id")  # at most 3 * per_class rows
        .groupBy("id", "good", "text")
        .agg(F.lit(1))
        .orderBy("id", "text")
        .limit(6 * per_class)
        .collect()
    )
    kinds: dict[bool, list[bytes]] = {True: [], False: []}
    for row in sorted(rows, key=lambda r: (hash_key(r["id"]), r["text"])):
        kinds[row["good"]].append(row["text"].encode())
    return fit(
        kinds[True], kinds[False], size, counts.get(True, 0) / counts[False] if counts.get(False) else None
    )


def hash_key(value: int) -> int:
    """A fixed mix of a number, to put rows in an order that has nothing to do with their ids."""
    return (value * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64) >> 16


def score_column(docs: DataFrame, model: QualityModel, text_col: str = "text") -> Column:
    """The score of a text column, for a filter that keeps all columns of `docs` as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array([score(shared.value, x.as_py().encode()) for x in texts], pa.float64())

    return scored(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def score_quality(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """`doc_id, score, predicted` per row. One narrow pass; the model is two dictionaries of a fixed size.

    A null text is empty; empty texts get the score of no difference. Repeated
    rows are scored each and alike, a null id stays null, no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for rows, data, ends in text_blocks(batches):
            raw = data.tobytes()
            scores = np.array([score(shared.value, raw[a:b]) for a, b in zip(ends, ends[1:])], np.float64)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(run, "doc_id long, score double, predicted int")
