"""Near-duplicates of embeddings by a PCA-ordered, tiled comparison.

All pairs are compared, tile by tile, in double precision. A tile's vectors are turned to their principal axes,
so a product of two vectors gets most of its sum from the leading dimensions. These are
accumulated first; what the rest can add is at most the product of the two suffix norms. A pair is given up as
soon as this bound cannot reach the threshold, usually after the first dimensions.

The same bound spares whole tiles: unit vectors of cosine t are at most sqrt(2 - 2t) apart, on every axis. Tiles
are cells of that width on the two leading axes, cut by a hash if they hold more than a tile
can; only tiles of the same or neighbouring cells meet. Equal vectors are one row with a number of copies. A pair
of tiles returns counts per vector and one link per vector at most, never the pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.llm import words
from areacast.llm.graph import components
from areacast.sources.tables import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE = 4096
_ROWS = 512
_LEADING = 16
# Products this near to the threshold are computed again from the vectors as they are.
_NEAR = 1e-9


def _parsed(vectors: DataFrame) -> DataFrame:
    """(id, node, dims, vector): node is the digest of a vector that can link, null for others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, kept = [], []
            for value in batch.column(1):
                own = None
                if value.is_valid and len(value) and value.values.null_count == 0:
                    own = value.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                    if not np.isfinite(own).all() or not own.any():
                        own = None
                nodes.append(None if own is None else xxhash.xxh3_128_digest(own.tobytes()))
                kept.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.binary()),
                 pa.array([0 if k is None else len(k) for k in kept], pa.int32()),
                 words.lists(kept, pa.float64())],
                ["id", "node", "dims", "vector"],
            )

    return vectors.mapInArrow(run, "id bigint, node binary, dims int, vector array<double>")


def _units(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy().reshape(-1, dims)


def _exact(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Cosines of rows with rows, from the vectors as they are."""
    one = one / np.abs(one).max(axis=1, keepdims=True)
    two = two / np.abs(two).max(axis=1, keepdims=True)
    norms = np.sqrt((one * one).sum(axis=1) * (two * two).sum(axis=1))
    return (one * two).sum(axis=1) / norms


def close_pairs(
    left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i, j) of pairs with that cosine, some rows of ``left`` at a time."""
    a, b = _units(left) @ axes, _units(right) @ axes
    dims = a.shape[1]
    cuts = [c for c in (_LEADING, 2 * _LEADING, 4 * _LEADING) if c < dims] + [dims]

    def suffix(rows: np.ndarray, start: int) -> np.ndarray:
        return np.linalg.norm(rows[:, start:], axis=1)

    for low in range(0, len(a), _ROWS):
        part = a[low : low + _ROWS]
        sums = part[:, : cuts[0]] @ b[:, : cuts[0]].T
        bound = sums + suffix(part, cuts[0])[:, None] * suffix(b, cuts[0])[None, :]
        i, j = np.nonzero(bound >= threshold - _NEAR)
        sums = sums[i, j]
        for start, stop in zip(cuts, cuts[1:]):
            for k in range(0, len(i), 1 << 16):
                at = slice(k, k + (1 << 16))
                sums[at] += np.einsum("nd,nd->n", part[i[at], start:stop], b[j[at], start:stop])
            alive = sums + suffix(part, stop)[i] * suffix(b, stop)[j] >= threshold - _NEAR
            i, j, sums = i[alive], j[alive], sums[alive]
        i = i + low
        doubt = np.flatnonzero(np.abs(sums - threshold) <= _NEAR)
        fits = sums >= threshold
        if len(doubt):
            fits[doubt] = _exact(left[i[doubt]], right[j[doubt]]) >= threshold
        yield i[fits], j[fits]


def _tile_pair(rows: pa.Table, dims: int, axes: np.ndarray, threshold: float) -> pa.Table:
    """Rows (a, b, n): vector a has n links here (b null), or is in one component with b (n null)."""
    side = rows.column("side").to_numpy()
    nodes = np.array(rows.column("node").to_pylist(), dtype=object)
    copies = rows.column("copies").to_numpy()
    vectors = _matrix(rows.column("vector"), dims)
    left, right = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)
    counts = np.zeros(len(nodes), np.int64)
    label = np.arange(len(nodes))
    found = []
    if len(left) and len(right):
        for i, j in close_pairs(vectors[left], vectors[right], axes, threshold):
            x, y = left[i], right[j]
            x, y = x[x != y], y[x != y]
            counts += np.bincount(x, copies[y], len(nodes)).astype(np.int64)
            if side.any():
                counts += np.bincount(y, copies[x], len(nodes)).astype(np.int64)
            found.append((x.astype(np.int32), y.astype(np.int32)))
    # The smallest number that links reach.
    while True:
        before = label.copy()
        for x, y in found:
            np.minimum.at(label, x, label[y])
            np.minimum.at(label, y, label[x])
        label = label[label]
        if (label == before).all():
            break
    linked, moved = np.flatnonzero(counts), np.flatnonzero(label != np.arange(len(nodes)))
    return pa.table({
        "a": pa.array([*nodes[linked], *nodes[moved]], pa.binary()),
        "b": pa.array([None] * len(linked) + list(nodes[label[moved]]), pa.binary()),
        "n": pa.array([*counts[linked].tolist(), *[None] * len(moved)], pa.int64()),
    })


def _compared(nodes: DataFrame, dims: int, threshold: float) -> DataFrame:
    """The results of all pairs of tiles of vectors of that length."""
    # Of unit vectors, as they are compared; scaled before, so that no square overflows.
    scaled = F.transform("vector", lambda x: x / F.array_max(F.transform("vector", F.abs)))
    units = Normalizer(inputCol="scaled", outputCol="v").transform(
        nodes.select(array_to_vector(scaled).alias("scaled"))
    )
    fitted = PCA(k=dims, inputCol="v", outputCol="w").fit(units)
    axes = fitted.pc.toArray()
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.floor(_units(_matrix(batch.column(2), dims)) @ axes[:, :2] / width)
            cells = cells.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells[:, 0]), pa.array(cells[:, -1])],
                ["node", "copies", "vector", "x", "y"],
            )

    cells = nodes.select("node", "copies", "vector").mapInArrow(
        placed, "node binary, copies bigint, vector array<double>, x int, y int"
    )
    cells = written(cells, "cells")
    tiles = cells.groupBy("x", "y").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    # Each cell with the tiles of the cells around it.
    steps = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)
    ]))
    around = tiles.select(F.col("x").alias("at_x"), F.col("y").alias("at_y"), "tiles")
    near = tiles.select("x", "y", F.col("tiles").alias("own"), steps.alias("s")).withColumns({
        "at_x": F.col("x") + F.col("s.i"), "at_y": F.col("y") + F.col("s.j"),
    }).join(around, ["at_x", "at_y"])
    near = near.groupBy("x", "y", "own").agg(
        F.collect_list(F.struct("at_x", "at_y", "tiles")).alias("near")
    )

    def tile(x, y, i):
        return F.struct(x.alias("x"), y.alias("y"), i.cast("int").alias("i"))

    own = tile(F.col("x"), F.col("y"), F.pmod(F.xxhash64("node"), F.col("own")))
    partners = F.flatten(F.transform("near", lambda c: F.transform(
        F.sequence(F.lit(0), c["tiles"].cast("int") - 1), lambda i: tile(c["at_x"], c["at_y"], i)
    )))
    rows = cells.join(near, ["x", "y"]).withColumn("own_tile", own).select(
        "node", "copies", "vector", "own_tile", F.explode(partners).alias("other")
    )
    side = F.when(F.col("own_tile") == F.col("other"), 0).when(
        F.col("own_tile") < F.col("other"), 1).otherwise(2)
    rows = rows.select(
        F.least("own_tile", "other").alias("one"), F.greatest("own_tile", "other").alias("two"),
        side.alias("side"), "node", "copies", "vector",
    )
    return rows.groupBy("one", "two").applyInArrow(
        lambda table: _tile_pair(table, dims, axes, threshold), "a binary, b binary, n bigint"
    )


def near_vectors(
    vectors: DataFrame, id_column: str, vector: str = "embedding", threshold: float = 0.9
) -> DataFrame:
    """(id, n_links, component_id, kept) of each vector, by cosine in double precision.

    Vectors that are null, empty or zero or hold null or non-finite components link with nothing. Vectors of
    different lengths do not link. Equal vectors link whatever the threshold; a component has the smallest id
    of its vectors that is not null, and the vector with this id is kept.
    """
    source = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")
    )
    parsed = written(_parsed(source), "vectors")
    nodes = parsed.where("node is not null")
    nodes = nodes.groupBy("node").agg(
        F.count("*").alias("copies"), F.min("id").alias("first"), F.max("dims").alias("dims")
    ).join(nodes.select("node", "vector").dropDuplicates(["node"]), "node")
    nodes = written(nodes, "nodes")
    found = parsed.sparkSession.createDataFrame([], "a binary, b binary, n bigint")
    # Lengths, not vectors: one or a few.
    for row in nodes.groupBy("dims").count().where("count > 1").collect():
        own = nodes.where(F.col("dims") == row["dims"])
        found = found.unionByName(written(_compared(own, row["dims"], threshold), "pairs"))
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    named = nodes.select("node", "copies", "first").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    classes = named.groupBy("root").agg(F.min("first").alias("class"))
    named = named.join(classes, "root").join(counts, "node", "left").select(
        "node", "class", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n")
    )
    marked = parsed.select("id", "node").join(named, "node", "left")
    component = F.when(F.col("class").isNotNull(), F.col("class")).otherwise(F.col("id"))
    return marked.select(
        F.col("id").alias(id_column),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
