"""Centroid clustering in whole numbers, with a vantage-point tree over the centroids.

Vectors become whole numbers, so distances, ties and means are exact and a rerun agrees to the last digit,
however the rows are dealt. The vectors are written once in that form. A round is one pass over them: the tree over the
round's centroids is built on the driver and broadcast (its size is centroids x dimensions), each task
assigns its vectors and returns one sum per centroid and dimension, and the sums of all tasks make the next centroids.

The tree is searched best-first for each vector: of its open nodes the one with the smallest lower bound comes next, until no
open node can hold a centroid as near as the nearest one found. The vectors of a batch take their steps together, grouped by node.
Lower bounds come from the triangle inequality in doubles and are lowered by more than their rounding; the pruning radius is inclusive,
so a centroid at the same distance with a smaller number is always met. Distances at vantage points and in leaves are exact.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.llm import numbers
from areacast.sources.tables import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF = 2
# What bounds are lowered by, relative to the distances they come from.
_SLACK = 1e-9
# Bounds held at once: rows x nodes.
_BOUNDS = 1 << 22


def limit(dims: int) -> int:
    """The largest component whose squared distances are sure to fit a long."""
    return math.isqrt(numbers.LONG_MAX // dims) // 2


@dataclass(frozen=True)
class Node:
    """A leaf with its centroids; or a vantage point and its children (node, least, most distance from it)."""

    centroids: tuple[int, ...]
    children: tuple[tuple[int, float, float], ...] = ()


def squared(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances."""
    apart = rows - centroid
    return np.einsum("nd,nd->n", apart, apart)


def vantage_tree(centroids: np.ndarray, leaf: int = LEAF) -> list[Node]:
    """Nodes of a balanced tree; the root is node 0.

    The vantage point is the centroid whose distances to the others vary most; the nearer half is one child.
    """
    nodes: list[Node] = []

    def build(members: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(Node(tuple(members.tolist())))
        if len(members) > leaf:
            apart = [np.sqrt(squared(centroids[members], centroids[m]).astype(np.float64)) for m in members]
            chosen = int(np.argmax([a.var() for a in apart]))
            order = np.argsort(apart[chosen], kind="stable")
            order = order[order != chosen]
            children = []
            for half in (order[: (len(order) + 1) // 2], order[(len(order) + 1) // 2 :]):
                if len(half):
                    far = apart[chosen][half]
                    children.append((build(members[half]), float(far.min()), float(far.max())))
            nodes[at] = Node((int(members[chosen]),), tuple(children))
        return at

    build(np.arange(len(centroids)))
    return nodes


def nearest(
    rows: np.ndarray, centroids: np.ndarray, tree: list[Node]
) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid; the smaller number on a tie."""
    step = max(1, _BOUNDS // len(tree))
    parts = [_nearest(rows[i : i + step], centroids, tree) for i in range(0, len(rows), step)]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _nearest(rows: np.ndarray, centroids: np.ndarray, tree: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    best = np.full(len(rows), numbers.LONG_MAX)
    who = np.full(len(rows), len(centroids))
    bounds = np.full((len(rows), len(tree)), np.inf)
    bounds[:, 0] = 0
    searching = np.arange(len(rows))
    while len(searching):
        at_node = bounds[searching].argmin(axis=1)
        least = bounds[searching, at_node]
        # Inclusive: a node that may hold a centroid at the same distance is opened.
        alive = least <= np.sqrt(best[searching].astype(np.float64)) * (1 + _SLACK)
        searching, at_node, least = searching[alive], at_node[alive], least[alive]
        for number in np.unique(at_node):
            here = at_node == number
            own, floor = searching[here], least[here]
            bounds[own, number] = np.inf
            node = tree[number]
            for c in node.centroids:
                apart = squared(rows[own], centroids[c])
                nearer = (apart < best[own]) | ((apart == best[own]) & (c < who[own]))
                best[own[nearer]], who[own[nearer]] = apart[nearer], c
            if node.children:
                away = np.sqrt(apart.astype(np.float64))
                for child, low, high in node.children:
                    bound = np.maximum(low - away, away - high) - _SLACK * (away + high)
                    bounds[own, child] = np.maximum(floor, bound)
    return who, best


def _assigned(batch: pa.RecordBatch, column: str, dims: int, model) -> tuple[np.ndarray, ...]:
    centroids, tree = model.value
    rows = numbers.matrix(batch.column(column), dims).astype(np.int64)
    return rows, *nearest(rows, centroids, tree)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of their vectors, exactly; empty ones stay."""
    dims = centroids.shape[1]
    model = vectors.sparkSession.sparkContext.broadcast((centroids, vantage_tree(centroids)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            rows, who, _ = _assigned(batch, "x", dims, model)
            for c in np.unique(who).tolist():
                own = rows[who == c]
                sums = [*numbers.column_sums(own), len(own)]
                totals[c] = [a + b for a, b in zip(totals.get(c, [0] * (dims + 1)), sums)]
        for c, sums in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * len(sums), pa.int32()), pa.array(range(len(sums)), pa.int32()),
                 numbers.decimals(sums)],
                ["cluster", "place", "total"],
            )

    partial = vectors.select("x").mapInArrow(run, f"cluster int, place int, total {numbers.EXACT}")
    sums = numbers.summed(partial, ["cluster", "place"])
    model.destroy()
    moved = centroids.copy()
    for c in {c for c, _ in sums}:
        count = int(sums[c, dims])
        moved[c] = [int(sums[c, i]) // count for i in range(dims)]
    return moved


def kept_vectors(
    vectors: DataFrame, id_column: str, vector: str = "embedding", dims: int = 64, scale: int = 1024
) -> DataFrame:
    """(id, x): x holds floor(scale * c) of the vectors with exactly ``dims`` given and finite components."""
    kept = vectors.where(F.size(vector) == dims).select(
        F.col(id_column).cast("bigint").alias("id"),
        numbers.whole(F.col(vector), scale, limit(dims)).cast("array<int>").alias("x"),
    )
    return kept.where("x is not null")


def first_centroids(kept: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``seed:id``, in that order; equal ids by their components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = kept.orderBy(name.asc_nulls_last(), "x").select("x").limit(count).collect()
    return np.array([r["x"] for r in rows], np.int64)


def cluster(
    vectors: DataFrame,
    id_column: str,
    vector: str = "embedding",
    count: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of each kept vector.

    Kept are vectors of exactly ``dims`` components, none null or non-finite; a component c becomes floor(scale * c). The first
    centroids are the kept vectors with the smallest hash of their id (null ids last, repeated ids by their
    components), all of them if there are fewer than ``count``; each of the rounds moves every centroid that
    has vectors to the floor of their mean. Equal rows, and rows that repeat an id, are rows of their own. Vectors with a
    component beyond :func:`limit` are left out as well: their distances fit no long. An empty
    table gives no rows. ``cluster_inertia`` or ``inertia`` is null where a long cannot hold the sum.
    """
    spark = vectors.sparkSession
    kept = written(kept_vectors(vectors, id_column, vector, dims, scale), "whole_vectors")
    centroids = first_centroids(kept, count, seed)
    if not len(centroids):
        return _named(spark, kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")),
                      [], id_column)
    for _ in range(rounds):
        centroids = _moved(kept, centroids)
    model = spark.sparkContext.broadcast((centroids, vantage_tree(centroids)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, who, apart = _assigned(batch, "x", dims, model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(who, pa.int32()), pa.array(apart, pa.int64())],
                ["id", "cluster", "distance"],
            )

    placed = written(kept.mapInArrow(run, "id bigint, cluster int, distance bigint"), "clusters")
    model.destroy()
    sums = numbers.summed(
        placed.select("cluster", F.col("distance").cast(numbers.EXACT).alias("total")), ["cluster"]
    )
    inertia = numbers.long_or_none(int(sum(sums.values())))
    named = [
        (c, numbers.long_or_none(int(total)), inertia, centroids[c].tolist())
        for (c,), total in sums.items()
    ]
    return _named(spark, placed, named, id_column)


def _named(spark: SparkSession, placed: DataFrame, clusters: list[tuple], id_column: str) -> DataFrame:
    # One row per centroid: a small table whatever the number of vectors.
    of_cluster = spark.createDataFrame(
        clusters, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    )
    return placed.join(F.broadcast(of_cluster), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
