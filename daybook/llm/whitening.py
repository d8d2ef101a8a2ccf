"""Whitening of embeddings from a covariance weighted by multiplicity.

Components become whole numbers, so equal vectors are found by equality. Each
distinct vector is kept once with the number of its copies, which is its weight
in sums and in the covariance. Tasks multiply matrices of centred distinct
vectors; their results are added in a tree. A distinct vector is whitened once
and its rows are joined with the result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import written
from daybook.operators.joins import join_on_key

#: Largest absolute whole number that a component may become.
MOST = 1 << 60
#: Vectors that one step of a task multiplies.
ROWS_AT_ONCE = 8192
#: Matrices that one task adds.
FAN_IN = 32


@dataclass(frozen=True)
class Whitening:
    """A fitted model: a few numbers per dimension and component."""

    n: int  #: weight of all vectors
    sums: list[int]  #: per dimension, exact
    components: np.ndarray  #: unit eigenvectors in rows, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float | None]:
        return [float(e) / self.trace if self.trace > 0 else None for e in self.eigenvalues]

    @property
    def scales(self) -> list[float | None]:
        """Standard deviation along each component; None where there is no variance beyond rounding."""
        least = len(self.sums) * np.finfo(float).eps * max(self.trace, 0.0)
        return [float(np.sqrt(e)) if e > least else None for e in self.eigenvalues]


def whole_numbers(vector: Column, scale: int, shift: int) -> Column:
    # an attempt, as Spark may evaluate this before it has left out what does not fit
    return F.transform(vector, lambda c: F.try_add(F.floor(c.cast("double") * scale), F.lit(shift).cast("long")))


def usable(vector: Column, scale: int) -> Column:
    """Neither null nor empty, all components finite and, scaled, within `MOST`."""
    fits = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * scale < float(MOST)))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fits, F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _steps(batches, dims: int, value: str):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            yield _matrix(part.column(value), dims), part.column("weight").to_numpy()


def _added(spark, partials: DataFrame, tasks: int, add) -> bytes | None:
    """One result of the tasks' partial results (`payload` binary), added `FAN_IN` at a time."""

    def run(batches):
        total = None
        for batch in batches:
            for payload in batch.column("payload"):
                other = payload.as_py()
                total = other if total is None else add(total, other)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.binary())], names=["payload"])

    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        partials = partials.repartition(tasks).mapInArrow(run, "payload binary")
    row = partials.first()
    return None if row is None else bytes(row["payload"])


def _pack_whole(numbers) -> bytes:
    return b"".join(int(x).to_bytes(24, "little", signed=True) for x in numbers)


def _unpack_whole(raw: bytes) -> list[int]:
    return [int.from_bytes(raw[at : at + 24], "little", signed=True) for at in range(0, len(raw), 24)]


def whole_sums(table: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The sum of the weights, and the exact weighted sums of the dimensions of `x`."""

    def run(batches):
        totals = [0] * (dims + 1)
        for x, weight in _steps(batches, dims, "x"):
            most = int(np.abs(x).max(initial=0)) * int(weight.sum())
            kind = np.int64 if most < 1 << 62 else object
            sums = weight.astype(kind) @ x.astype(kind)
            totals = [a + int(b) for a, b in zip(totals, [weight.sum(), *sums])]
        yield pa.RecordBatch.from_arrays([pa.array([_pack_whole(totals)], pa.binary())], names=["payload"])

    def add(one: bytes, other: bytes) -> bytes:
        return _pack_whole(a + b for a, b in zip(_unpack_whole(one), _unpack_whole(other)))

    raw = _added(table.sparkSession, table.mapInArrow(run, "payload binary"), table.rdd.getNumPartitions(), add)
    n, *sums = _unpack_whole(raw) if raw else [0] * (dims + 1)
    return n, sums


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x minus the mean. The mean's whole part goes first, exactly, so nothing is lost to cancellation."""
    base = [s // n for s in sums]
    rest = np.array([(s - b * n) / n for s, b in zip(sums, base)])
    return (x - np.array(base, np.int64)).astype(np.float64) - rest


def _products(table: DataFrame, dims: int, value: str, centre) -> np.ndarray:
    """Weighted sum of the outer products of centred vectors, as matrix products of many rows."""

    def run(batches):
        total = np.zeros((dims, dims))
        for x, weight in _steps(batches, dims, value):
            y = centre(x)
            total += (y * weight[:, None]).T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["payload"])

    def add(one: bytes, other: bytes) -> bytes:
        return (np.frombuffer(one) + np.frombuffer(other)).tobytes()

    raw = _added(table.sparkSession, table.mapInArrow(run, "payload binary"), table.rdd.getNumPartitions(), add)
    return np.frombuffer(raw).reshape(dims, dims) if raw else np.zeros((dims, dims))


def _means(table: DataFrame, dims: int, value: str, n: int) -> np.ndarray:
    def run(batches):
        total = np.zeros(dims)
        for x, weight in _steps(batches, dims, value):
            total += weight @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["payload"])

    def add(one: bytes, other: bytes) -> bytes:
        return (np.frombuffer(one) + np.frombuffer(other)).tobytes()

    raw = _added(table.sparkSession, table.mapInArrow(run, "payload binary"), table.rdd.getNumPartitions(), add)
    return (np.frombuffer(raw) if raw else np.zeros(dims)) / n


def fit(distinct: DataFrame, dims: int, components: int) -> Whitening | None:
    """The model of a table of `x` (whole numbers, `dims` each) and `weight`; None without rows."""
    n, sums = whole_sums(distinct, dims)
    if not n:
        return None
    covariance = _products(distinct, dims, "x", lambda x: centred(x, n, sums)) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    rows = vectors[:, order].T
    largest = rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)]
    return Whitening(n, sums, rows * np.sign(largest)[:, None], values[order], float(np.trace(covariance)))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - sum) squared, exact; None where it exceeds a long."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, sums), default=0)
    off = None
    if most < 1 << 62:
        off = x * np.int64(n) - np.array(sums, np.int64)
        if int(np.abs(off).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
            return (off * off).sum(axis=1).tolist()
    if off is None:
        off = x.astype(object) * n - np.array(sums, object)
    found = [int(d) for d in (off.astype(object) ** 2).sum(axis=1)]
    return [d if d < 1 << 63 else None for d in found]


def apply(distinct: DataFrame, model: Whitening, dims: int) -> DataFrame:
    """`x, weight, deviation, whitened` of each distinct vector. Components without variance are null."""
    scales = model.scales
    turn = model.components.T / np.array([s or 1.0 for s in scales])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                x = _matrix(part.column("x"), dims)
                z = centred(x, model.n, model.sums) @ turn
                empty = np.tile([s is None for s in scales], len(z))
                values = pa.array(z.ravel(), pa.float64(), mask=empty)
                ends = pa.array(np.arange(0, z.size + 1, z.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("x"),
                        part.column("weight"),
                        pa.array(deviations(x, model.n, model.sums), pa.int64()),
                        pa.ListArray.from_arrays(ends, values),
                    ],
                    names=["x", "weight", "deviation", "whitened"],
                )

    return distinct.mapInArrow(run, "x array<long>, weight long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, from the vectors themselves."""
    live = [k for k, s in enumerate(model.scales) if s is not None]
    if not live:
        return None
    rows = whitened.select(F.array(*(F.col("whitened")[k] for k in live)).alias("z"), "weight")
    mean = _means(rows, len(live), "z", model.n)
    covariance = _products(rows, len(live), "z", lambda z: z - mean) / model.n
    return float(np.abs(covariance - np.eye(len(live))).max())


def whiten(
    table: DataFrame,
    components: int = 8,
    scale: int = 1024,
    shift: int = 100_000,
    weights: str = "count",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, Whitening | None, float | None]:
    """Rows `vec_id, deviation, whitened` of all usable vectors, the model, and the identity error.

    A component c becomes floor(scale * c) + shift. `weights` says what a
    distinct vector counts in the fit: `count`, the number of its rows, or
    `one`. `whitened` has up to `components` values, fewer if vectors are shorter.

    Rows whose vector is null, empty or holds a null, a component that is not
    finite or one that is 2^60 or more when scaled are left out, and so are
    vectors of another length than the most frequent one (ties: the shorter).
    Zero vectors take part. Ids may be null or repeat; each row is answered. A
    component without variance, as where all vectors are equal, is null in all
    rows. A deviation beyond a long is null. No usable rows give no rows and no
    model. Other columns are ignored.

    The driver and each task hold a matrix of dimensions x dimensions, whatever
    the number of rows. Copies of one vector are counted before the shuffle, and
    the join splits them.
    """
    if weights not in ("count", "one"):
        raise ValueError("weights are 'count' or 'one'")
    spark = table.sparkSession
    vector = F.col(vector_col)
    good = table.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("_v")).where(usable(F.col("_v"), scale))
    lengths = good.groupBy(F.size("_v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    result = T.StructType.fromDDL("vec_id long, deviation long, whitened array<double>")
    if lengths is None:
        return spark.createDataFrame([], result), None, None
    dims = lengths["d"]
    rows = good.where(F.size("_v") == dims).select("vec_id", whole_numbers(F.col("_v"), scale, shift).alias("x"))
    weight = F.count("*") if weights == "count" else F.lit(1).cast("long")
    distinct = written(rows.groupBy("x").agg(weight.alias("weight")), "whitening")
    model = fit(distinct, dims, components)
    once = written(apply(distinct, model, dims), "whitening")
    joined = join_on_key(rows, once.drop("weight"), "x", "inner")
    return joined.select("vec_id", "deviation", "whitened"), model, identity_error(once, model)
