"""Centroid clustering and whitening of embeddings against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from areacast.llm import clusters, whitening


def kept(rows, dims, scale, most):
    for r in rows:
        v = r["embedding"]
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            x = [math.floor(scale * float(np.float32(c))) for c in v]
            if max(map(abs, x)) <= most:
                yield r["vec_id"], x


def clustered(rows, count, rounds, dims, scale):
    """(id, cluster, distance, inertia of it, of all, centroid) in whole numbers."""
    points = list(kept(rows, dims, scale, clusters.limit(dims)))

    def first(p):
        name = None if p[0] is None else hashlib.sha256(f"3:{p[0]}".encode()).hexdigest()
        return name is None, name or "", p[1]

    centroids = [x for _, x in sorted(points, key=first)[:count]]
    for turn in range(rounds + 1):
        placed = [
            min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids)) for _, x in points
        ]
        if turn < rounds:
            for i in range(len(centroids)):
                own = [x for (_, x), (_, j) in zip(points, placed) if j == i]
                if own:
                    centroids[i] = [sum(column) // len(own) for column in zip(*own)]
    of = Counter()
    for distance, i in placed:
        of[i] += distance
    return [(p[0], i, d, of[i], sum(of.values()), tuple(centroids[i])) for p, (d, i) in zip(points, placed)]


def rows_of(found):
    return Counter((*tuple(r)[:5], tuple(r["centroid"])) for r in found.collect())


def test_cluster(spark, folder, data):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").withColumn("cluster", F.lit("old"))
    found = clusters.cluster(vectors, "vec_id", count=8, rounds=10, dims=24)
    assert rows_of(found) == Counter(clustered(data["embeddings"], 8, 10, 24, 1024))


def test_ties_repeats_and_left_out_rows(spark):
    # A coarse grid: equal distances, equal centroids, clusters that stay empty.
    draw = random.Random(2)
    rows = [(i // 2 if i % 7 else None, [float(draw.randint(-1, 1)) for _ in range(3)]) for i in range(200)]
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [float("nan"), 1.0, 1.0]),
             (905, [float("inf"), 0.0, 0.0]), (906, [1e30, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id int, embedding array<float>").repartition(5)
    found = rows_of(clusters.cluster(vectors, "vec_id", count=12, rounds=4, dims=3, scale=1))
    plain = [{"vec_id": i, "embedding": v} for i, v in rows]
    assert found == Counter(clustered(plain, 12, 4, 3, 1))
    few = clusters.cluster(vectors.where("vec_id in (2, 3)"), "vec_id", count=12, dims=3)
    assert few.count() == 3
    assert clusters.cluster(vectors.limit(0), "vec_id").count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 8, 40, 200])
def test_nearest_is_the_smallest_of_the_nearest(count):
    draw = np.random.default_rng(count)
    centroids = draw.integers(-3, 4, (count, 4))
    rows = draw.integers(-4, 5, (500, 4))
    tree = clusters.vantage_tree(centroids)
    who, apart = clusters.nearest(rows, centroids, tree)
    all_of = ((rows[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (who == all_of.argmin(axis=1)).all() and (apart == all_of.min(axis=1)).all()
    assert sorted({c for n in tree for c in n.centroids}) == list(range(count))


def test_nearest_at_the_limit_is_exact():
    most = clusters.limit(64)
    centroids = np.full((3, 64), most)
    centroids[1:, 0] -= 1
    rows = np.full((2, 64), -most)
    rows[1, 0] += 1
    who, apart = clusters.nearest(rows, centroids, clusters.vantage_tree(centroids))
    assert who.tolist() == [1, 1]
    assert apart.tolist() == [63 * (2 * most) ** 2 + (2 * most - 1 - i) ** 2 for i in range(2)]


def test_only_promising_nodes_are_opened(monkeypatch):
    # Far-apart clumps: a search meets few of the 256 centroids.
    draw = np.random.default_rng(1)
    centroids = (np.repeat(draw.integers(-10**6, 10**6, (16, 8)), 16, axis=0) + draw.integers(-50, 50, (256, 8)))
    rows = centroids[draw.integers(0, 256, 400)] + draw.integers(-20, 20, (400, 8))
    seen, exact = [0], clusters.squared
    tree = clusters.vantage_tree(centroids)
    monkeypatch.setattr(clusters, "squared", lambda r, c: (seen.__setitem__(0, seen[0] + len(r)), exact(r, c))[1])
    who, _ = clusters.nearest(rows, centroids, tree)
    assert (who == ((rows[:, None] - centroids) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert seen[0] < 400 * 256 / 4


def checked(found, rows, dims, scale=256, keep=4):
    """The rows of that length against the singular vectors of the centred matrix."""
    points = list(kept(rows, dims, scale, whitening.LIMIT))
    distinct = np.array(sorted({tuple(x) for _, x in points}), float)
    n, sums = len(distinct), [int(s) for s in distinct.sum(axis=0)]
    centred = distinct - distinct.mean(axis=0)
    _, singular, axes = np.linalg.svd(centred)
    values, axes = np.concatenate([singular**2 / n, np.zeros(dims)])[:dims], axes.T
    real = min(keep, int((singular > 1e-9 * singular[0]).sum())) if singular[0] > 0 else 0
    own = [r for r in found if len(r["whitened"]) == real and r["n"] == n]
    deviation = Counter((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in points)
    assert Counter((r["vec_id"], r["deviation"]) for r in own) == deviation
    expected = {}
    for i, x in points:
        expected.setdefault(i, []).append((np.array(x) - np.array(sums) / n) @ axes[:, :real] / np.sqrt(values[:real]))
    signs = None
    for r in own:
        near = min(expected[r["vec_id"]], key=lambda e: np.abs(np.abs(e) - np.abs(r["whitened"])).max(initial=0))
        assert np.abs(near) == pytest.approx(np.abs(r["whitened"]), rel=1e-7, abs=1e-8)
        assert r["explained"] == pytest.approx(values[:real] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
        own_signs = [np.sign(a * b) if abs(a) > 1e-6 else 0 for a, b in zip(near, r["whitened"])]
        signs = signs or own_signs
        assert len(expected[r["vec_id"]]) > 1 or all(a * b >= 0 for a, b in zip(signs, own_signs))
    return own


def test_whiten(spark, folder, data):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").withColumn("n", F.lit("old"))
    found = whitening.whiten(vectors, "vec_id").collect()
    assert len(checked(found, data["embeddings"], 24)) == len(list(kept(data["embeddings"], 24, 256, 1 << 53)))
    assert len(found) == sum(1 for d in (1, 2, 24) for _ in kept(data["embeddings"], d, 256, 1 << 53))


def test_whitening_of_few_directions(spark):
    # Six dimensions, two directions; one dimension is constant; the scales differ by a million.
    draw = random.Random(6)
    rows = []
    for i in range(300):
        a, b = draw.randint(-1000, 1000) * 1000.0, float(draw.randint(-20, 20))
        rows.append((i % 150, [a, a + b, b, 7.0, 2 * a, -b + 0.0]))
    rows += rows[:40] + [(None, rows[0][1]), (800, None), (801, []), (802, [1.0, None]), (803, [float("inf")] * 6), (804, [1e300] * 6)]
    vectors = spark.createDataFrame(rows, "vec_id int, embedding array<double>").repartition(4)
    found = whitening.whiten(vectors, "vec_id", scale=1).collect()
    plain = [{"vec_id": i, "embedding": v} for i, v in rows if v and len(v) == 6 and v[0] != 1e300]
    assert len(checked(found, plain, 6, scale=1)) == len(found) == 341
    assert all(len(r["whitened"]) == 2 for r in found)


def test_whitening_of_equal_rows_and_of_none(spark):
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)], "vec_id int, embedding array<float>")
    found = whitening.whiten(vectors, "vec_id").collect()
    assert [(r["vec_id"], r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in sorted(found)] == [
        (1, 1, 0, [], 0.0), (2, 1, 0, [], 0.0)
    ]
    assert whitening.whiten(vectors.where("vec_id = 3"), "vec_id").count() == 0


def test_ill_conditioned_rows_become_orthonormal():
    # A condition of 1e11 squares to 1e22 in a Gram matrix, which one Cholesky factor cannot take.
    draw = np.random.default_rng(3)
    rows = np.linalg.qr(draw.normal(size=(400, 12)))[0] * np.logspace(0, -11, 12) @ np.linalg.qr(draw.normal(size=(12, 12)))[0]

    def gram_of(factors):
        q = rows
        for f in factors:
            q = whitening.solved(q, f)
        return q.T @ q

    factors = whitening.orthogonalised(gram_of, 400, 12)
    assert np.abs(gram_of(factors) - np.eye(12)).max() < 1e-10
    product = np.eye(12)
    for f in factors:
        product = f @ product
    singular = np.linalg.svd(product)[1]
    assert singular[:6] == pytest.approx(np.logspace(0, -11, 12)[:6], rel=1e-7)


def test_deviation_beyond_a_long_is_null():
    model = whitening.Whitening(10**6, (0, 0), np.zeros((2, 0)), np.zeros(0), 1.0)
    assert model.deviations(np.array([[1, 2], [1 << 40, 0]])) == [5 * 10**12, None]
