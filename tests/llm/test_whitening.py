import math
from fractions import Fraction

import numpy as np
import pytest

from daybook.llm import whitening
from tests.llm.corpus import bag

SCHEMA = "vec_id long, embedding array<float>, x string, weight int, deviation string, _spread int, n string, d int"


def table(spark, pairs):
    full = [(i, v, "x", 1, "d", 2, "n", 3) for i, v in pairs]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def vectors(n=60, dims=5, seed=0):
    rng = np.random.default_rng(seed)
    data = (rng.standard_normal((n, dims)) @ rng.standard_normal((dims, dims))).astype(np.float32)
    pairs = [(i, [float(c) for c in v]) for i, v in enumerate(data)]
    pairs += [(n + i, pairs[0][1]) for i in range(40)]  # one vector holds a third of the rows
    return pairs + [(7, pairs[3][1]), (None, pairs[4][1]), (n + 50, [0.0] * dims)]


BAD = [
    (900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [math.nan] * 5),
    (904, [math.inf, 0.0, 0.0, 0.0, 0.0]), (905, [1.0, 2.0]), (906, [3e38] * 5),
]


def by_hand(pairs, components, weights="count"):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in pairs], object)
    fitted = x if weights == "count" else np.array([list(r) for r in {tuple(r) for r in x.tolist()}], object)
    n, sums = len(fitted), fitted.sum(axis=0)
    mean = [Fraction(int(s), n) for s in sums]
    exact = [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in fitted) / n for j in range(len(mean))] for i in range(len(mean))]
    v = np.array([[float(c) for c in r] for r in exact])
    values, turn = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    centred = np.array([[float(c - m) for c, m in zip(r, mean)] for r in x])
    z = centred @ turn[:, order] / np.sqrt(values[order])
    deviation = [int(sum((n * int(c) - int(s)) ** 2 for c, s in zip(r, sums))) for r in x]
    return n, [int(s) for s in sums], z, deviation, values[order] / np.trace(v)


@pytest.mark.parametrize("weights", ["count", "one"])
def test_against_exact_arithmetic(spark, weights):
    pairs = vectors()
    rows, model, error = whitening.whiten(table(spark, pairs + BAD), components=4, weights=weights)
    n, sums, z, deviation, explained = by_hand(pairs, 4, weights)
    assert (model.n, model.sums) == (n, sums)
    assert np.allclose(model.explained, explained, rtol=1e-9) and error < 1e-9
    found = rows.collect()
    assert bag((r.vec_id, r.deviation) for r in found) == bag((i, d) for (i, _), d in zip(pairs, deviation))
    where = {}
    for (i, _), own in zip(pairs, z):
        where.setdefault(i, []).append(own)
    signs = np.sign([found[0].whitened[k] / where[found[0].vec_id][0][k] for k in range(4)])
    for r in found:
        assert any(np.allclose(np.array(r.whitened) * signs, own, rtol=1e-8, atol=1e-9) for own in where[r.vec_id])


def test_a_vector_is_whitened_once(spark):
    rows, model, _ = whitening.whiten(table(spark, vectors()), components=2)
    distinct = spark.createDataFrame([([100_000] * 5, 3), ([100_001] * 5, 1)], "x array<long>, weight long")
    once = whitening.apply(distinct, model, 5).collect()
    assert [r.weight for r in once] == [3, 1] and all(len(r.whitened) == 2 for r in once)
    assert len({tuple(r.whitened) for r in rows.where("vec_id = 0 or vec_id >= 60 and vec_id < 100").collect()}) == 1


def test_fewer_dimensions_than_components(spark):
    pairs = [(i, [float(i), float(i * i % 7)]) for i in range(20)]
    rows, model, error = whitening.whiten(table(spark, pairs), components=8)
    assert {len(r.whitened) for r in rows.collect()} == {2} and error < 1e-9
    assert sum(model.explained) == pytest.approx(1)


def test_no_variance(spark):
    rows, model, error = whitening.whiten(table(spark, [(i, [0.5, 0.25]) for i in range(4)]), components=8)
    assert [(r.vec_id, r.deviation, r.whitened) for r in sorted(rows.collect())] == [(i, 0, [None, None]) for i in range(4)]
    assert error is None and model.explained == [None, None]
    flat = [(i, [float(i), 0.5]) for i in range(9)]
    rows, model, error = whitening.whiten(table(spark, flat), components=8)
    assert all(r.whitened[0] is not None and r.whitened[1] is None for r in rows.collect()) and error < 1e-9


@pytest.mark.parametrize("pairs", [[], BAD[:2]])
def test_no_usable_rows(spark, pairs):
    rows, model, error = whitening.whiten(table(spark, pairs))
    assert rows.collect() == [] and model is None and error is None
    assert rows.dtypes == [("vec_id", "bigint"), ("deviation", "bigint"), ("whitened", "array<double>")]


def test_large_numbers_stay_exact(spark):
    pairs = [(0, [3e13, 1.0]), (1, [-3e13, 1.0]), (2, [1.0, 1.0])]
    rows, model, _ = whitening.whiten(table(spark, pairs), components=1)
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in pairs]
    assert model.sums == [sum(c) for c in zip(*x)]
    want = [sum((3 * c - s) ** 2 for c, s in zip(r, model.sums)) for r in x]
    assert [r.deviation for r in sorted(rows.collect())] == [d if d < 2**63 else None for d in want]


def test_mean_and_products_lose_nothing():
    x = np.array([[10**15 + k, k] for k in range(7)], np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    assert whitening.centred(x, 7, sums).tolist() == [[k - 3.0, k - 3.0] for k in range(7)]


def test_unknown_weights(spark):
    with pytest.raises(ValueError):
        whitening.whiten(table(spark, []), weights="some")
