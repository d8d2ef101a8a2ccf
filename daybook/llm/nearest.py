"""Approximate nearest neighbours with an adaptive dimension scan.

Vectors lie in lists around centroids that were fitted on a bounded sample.
Within each probed list, rotated vectors are scanned in blocks of columns. After
each block, candidates are abandoned whose partial distance, scaled to all
dimensions, exceeds the distance of the k-th found so far with significance.
Distances of what is left are computed on the original vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import uniform, written

COLUMNS = 16
SIGNIFICANCE = 2.1
ROWS_AT_ONCE = 1024


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """k-means of a sample; distinct sample rows to begin with."""
    distinct = np.unique(sample, axis=0)
    rng = np.random.default_rng(0)
    centers = distinct[np.sort(rng.permutation(len(distinct))[:lists])].copy()
    for _ in range(rounds):
        own = nearest_lists(sample, centers, 1)[:, 0]
        sums = np.zeros_like(centers)
        np.add.at(sums, own, sample)
        counts = np.bincount(own, minlength=len(centers))
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def nearest_lists(vectors: np.ndarray, centers: np.ndarray, n: int) -> np.ndarray:
    """The `n` nearest centroids of each vector, nearest first, ties to the smaller number."""
    out = []
    for at in range(0, len(vectors), 4096):
        part = vectors[at : at + 4096]
        d = (centers * centers).sum(1)[None, :] - 2 * part @ centers.T
        out.append(np.argsort(d, axis=1, kind="stable")[:, :n])
    return np.concatenate(out) if out else np.zeros((0, n), np.int64)


def probes_for(sample: np.ndarray, centers: np.ndarray, k: int, recall: float, queries: int = 256) -> int:
    """Lists to probe so that the share `recall` of true neighbours within the sample lies in them.

    Neighbours in the whole table are nearer than those in a sample of it, so
    the share there is larger.
    """
    asked = sample[:queries]
    own = nearest_lists(sample, centers, 1)[:, 0]
    order = nearest_lists(asked, centers, len(centers))
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(centers))[None, :], axis=1)
    needed = []
    for q, vector in enumerate(asked):
        distance = ((sample - vector) ** 2).sum(axis=1)
        distance[q] = np.inf
        near = np.argsort(distance, kind="stable")[: min(k, len(sample) - 1)]
        needed.append(rank[q, own[near]])
    needed = np.sort(np.concatenate(needed)) if needed else np.zeros(0, np.int64)
    return int(needed[math.ceil(recall * len(needed)) - 1]) + 1 if len(needed) else 1


def scan(
    query: np.ndarray,
    rotated_query: np.ndarray,
    vectors: np.ndarray,
    columns: list[np.ndarray],
    ids: np.ndarray,
    k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the k nearest found in one list, ties to the smaller id, each id once."""
    dims = len(query)
    best_id, best = np.zeros(0, np.int64), np.zeros(0)
    for at in range(0, len(ids), ROWS_AT_ONCE):
        alive = np.arange(at, min(at + ROWS_AT_ONCE, len(ids)))
        limit = best[k - 1] ** 2 if len(best) >= k else np.inf
        partial = np.zeros(len(alive))
        seen = 0
        for b, block in enumerate(columns):
            step = block[alive] - rotated_query[b * COLUMNS : b * COLUMNS + block.shape[1]]
            partial += np.einsum("ij,ij->i", step, step)
            seen += block.shape[1]
            if np.isfinite(limit):
                slack = (1 + SIGNIFICANCE / np.sqrt(seen)) ** 2 if seen < dims else 1 + 1e-6
                keep = partial * (dims / seen) <= limit * slack + 1e-12
                alive, partial = alive[keep], partial[keep]
            if not len(alive):
                break
        if len(alive):
            exact = np.sqrt(np.square(vectors[alive].astype(np.float64) - query).sum(axis=1))
            all_id, all_d = np.concatenate([best_id, ids[alive]]), np.concatenate([best, exact])
            order = np.lexsort((all_id, all_d))
            all_id, all_d = all_id[order], all_d[order]
            _, first = np.unique(all_id, return_index=True)
            first = np.sort(first)[:k]
            best_id, best = all_id[first], all_d[first]
    return best_id, best


def search(
    table: DataFrame, is_query: Column, k: int = 10, lists: int | None = None, recall: float = 0.98, sample: int = 20_000,
    block_rows: int = 8192, block_queries: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """`query_id, rank, vec_id, score` (Euclidean, double): up to `k` neighbours of each row that `is_query` marks.

    Every usable row is indexed. Centroids are fitted on at most about `sample`
    rows, taken by a hash of the id, at most 32 MB; there are `lists` of them,
    by default half the root of the rows, from 1 to 4,096. As many of the nearest lists are
    searched as hold the share `recall` of the true neighbours of 256 sample
    rows within the sample, and further ones until they hold 50 * k rows. Long lists are cut into blocks
    of `block_rows` rows and `block_queries` queries, so that a vector that
    repeats for a third of all rows fills many tasks.

    Vectors that are null, empty, zero or hold a null or a component that is
    not finite take no part, neither do those of another length than the most
    frequent one, nor null ids. Rows with the id of the query are no
    candidates. A candidate id counts once, at its nearest. A query id that
    repeats is answered once, as its smallest vector. No rows give no rows.
    """
    spark = table.sparkSession
    rows = table.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    result = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy(
        F.size("vector").alias("d")
    ).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], result)
    dims, total = lengths["d"], lengths["n"]
    rows = rows.where(F.size("vector") == dims)
    bound = min(sample, (32 << 20) // (8 * dims))
    taken = rows.where(uniform("vec_id") < min(1.0, bound / total)).select(
        F.col("vector").cast("array<double>").alias("v"), "vec_id"
    ).orderBy(F.xxhash64("vec_id"), "vec_id").limit(2 * bound).collect()
    fitted = np.array([r["v"] for r in taken] or [[1.0] * dims])
    n_lists = lists or int(min(4096, max(1, np.sqrt(total) / 2)))
    turn = rotation(dims)
    centers = centroids(fitted @ turn, n_lists)
    probes = probes_for(fitted @ turn, centers, k, recall)
    shared = spark.sparkContext.broadcast((turn, centers))

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)

    def assign(batches):
        turn, centers = shared.value
        for batch in batches:
            if batch.num_rows:
                own = nearest_lists(matrix(batch.column("vector")) @ turn, centers, 1)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.astype(np.int32)), *batch.columns], names=["list", *batch.schema.names]
                )

    kind = dict(rows.dtypes)["vector"]
    assigned = written(
        rows.mapInArrow(assign, f"list int, vec_id long, vector {kind}, query boolean"), "nearest"
    )
    sizes = np.zeros(len(centers), np.int64)
    for r in assigned.groupBy("list").agg(F.count("*").alias("n")).collect():  # one row per list
        sizes[r["list"]] = r["n"]
    queries = assigned.where("query").groupBy("vec_id").agg(F.min("vector").alias("vector"))

    def probe(batches):
        turn, centers = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            near = nearest_lists(matrix(batch.column("vector")) @ turn, centers, len(centers))
            held = np.cumsum(sizes[near], axis=1)
            wanted = (np.arange(near.shape[1]) < probes) | (
                np.concatenate([np.zeros((len(near), 1)), held[:, :-1]], axis=1) < 50 * k
            )
            wanted &= sizes[near] > 0
            who, which = np.nonzero(wanted)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(near[who, which].astype(np.int32)),
                    batch.column("vec_id").take(pa.array(who)),
                    batch.column("vector").take(pa.array(who)),
                ],
                names=["list", "query_id", "target"],
            )

    probed = written(queries.mapInArrow(probe, f"list int, query_id long, target {kind}"), "nearest")
    asked = np.zeros(len(centers), np.int64)
    for r in probed.groupBy("list").agg(F.count("*").alias("n")).collect():
        asked[r["list"]] = r["n"]
    row_parts = [int(x) for x in np.maximum(1, -(-sizes // block_rows))]
    query_parts = [int(x) for x in np.maximum(1, -(-asked // block_queries))]
    row_part = F.element_at(F.lit(row_parts), F.col("list") + 1)
    query_part = F.element_at(F.lit(query_parts), F.col("list") + 1)
    left = assigned.select(
        "list", F.pmod(F.xxhash64("vec_id"), row_part).cast("int").alias("row_part"),
        F.explode(F.sequence(F.lit(0), query_part - 1)).alias("query_part"), "vec_id", "vector",
    )
    right = probed.select(
        "list", F.explode(F.sequence(F.lit(0), row_part - 1)).alias("row_part"),
        F.pmod(F.xxhash64("query_id"), query_part).cast("int").alias("query_part"), "query_id", "target",
    )

    def block(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        turn, _ = shared.value
        out = {"query_id": [], "vec_id": [], "score": []}
        if candidates.num_rows and asking.num_rows:
            vectors = matrix(candidates.column("vector").combine_chunks())
            ids = candidates.column("vec_id").to_numpy()
            turned = vectors @ turn
            columns = [np.ascontiguousarray(turned[:, c : c + COLUMNS]) for c in range(0, dims, COLUMNS)]
            targets = matrix(asking.column("target").combine_chunks())
            for own, target in zip(asking.column("query_id").to_pylist(), targets):
                found, score = scan(target, target @ turn, vectors, columns, ids, k + 1)
                keep = found != own
                out["query_id"] += [own] * int(min(k, keep.sum()))
                out["vec_id"] += found[keep][:k].tolist()
                out["score"] += score[keep][:k].tolist()
        return pa.table(
            out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        )

    keys = ["list", "row_part", "query_part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        block, "query_id long, vec_id long, score double"
    )
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = once.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("best")
    )
    return ranked.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
