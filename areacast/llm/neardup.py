"""MinHash near-duplicates of documents by tensored banding.

Two small collections of MinHash groups, u and v, are computed per document. The keys of the
tables are the pairs (u_i, v_j): 2 x 12 groups of 3 values (72 MinHash values) give 144 tables of
6 values, which plain banding would take 864 values for. Two documents of similarity s share a table with
probability (1 - (1 - s^3)^12)^2, 0.9996 at 0.8.

A pair key can be shared only if both of its halves are. Halves that no other document has
are dropped before any pair is formed, so only documents with a possible partner are expanded.

Documents with equal sets are one node. Nodes that tables join, directly or not, are a cluster.
In it, all nodes are first compared with one pivot, as full sets. Those linked to it need no
comparison with each other; the others are compared with all nodes, block by block inside
tasks that return links only, of pairs that share a table. So thousands of copies cost one comparison each, no pair is
written as a row, and no link that could join two components is left out. A cluster of very many nodes is
compared table by table instead, which is less work and finds the same: who shares no table is not linked in either.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.llm import words
from areacast.llm.blocks import block_pairs
from areacast.llm.graph import components
from areacast.sources.tables import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUPS, ROWS, SEED = 12, 3, 5
# Nodes of a block; nodes of a cluster beyond which its tables are compared one by one instead, with the same links.
BLOCK, LARGE = 256, 50_000
_COLUMNS = 4096


def _signatures(docs: DataFrame, n: int) -> DataFrame:
    """(id, size, node, keys, hash): size of the set, its digest, the keys of u and v in a row, the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = words.permutations(2 * GROUPS * ROWS, SEED)
        ids = words.WordIds()
        for batch in batches:
            sizes, nodes, keys = [], [], []
            for text in words.texts(batch.column(1)):
                found = words.shingle_set(ids.of(words.spaced_words(text)), n)
                sizes.append(len(found))
                nodes.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(
                    words.joined(words.minhashes(found, functions), ROWS) if len(found) else None
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                 words.lists(keys, pa.int64()), batch.column(2)],
                ["id", "size", "node", "keys", "hash"],
            )

    source = docs.select("id", "text", F.xxhash64("text").alias("hash"))
    return source.mapInArrow(
        run, "id bigint, size bigint, node binary, keys array<bigint>, hash bigint"
    )


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """(node, set): the full sets of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = words.WordIds()
        for batch in batches:
            step = 256
            for start in range(0, batch.num_rows, step):
                found = [
                    words.shingle_set(ids.of(words.spaced_words(text)), n)
                    for text in words.texts(batch.column(0).slice(start, step))
                ]
                nodes = [xxhash.xxh3_128_digest(f.tobytes()) if len(f) else None for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.binary()),
                     words.lists([f.view("int64") for f in found], pa.int64())],
                    ["node", "set"],
                )

    return docs.mapInArrow(run, "node binary, set array<bigint>")


def _tables(signatures: DataFrame) -> DataFrame:
    """(bucket, node) for the tables' keys that at least two nodes share."""
    keys = signatures.select("node", F.posexplode("keys").alias("i", "key"))
    shared = keys.groupBy("i", "key").count().where("count > 1").select("i", "key")
    halves = keys.join(shared, ["i", "key"], "left_semi")
    own = halves.groupBy("node").agg(F.collect_list(F.struct("i", "key")).alias("halves"))
    u = F.filter("halves", lambda h: h["i"] < GROUPS)
    v = F.filter("halves", lambda h: h["i"] >= GROUPS)
    pairs = F.flatten(F.transform(u, lambda a: F.transform(v, lambda b: F.xxhash64(a, b))))
    buckets = own.select("node", F.explode(pairs).alias("bucket"))
    shared = buckets.groupBy("bucket").count().where("count > 1").select("bucket")
    return buckets.join(shared, "bucket", "left_semi")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have that similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    of_a, of_b = F.size("set_a"), F.size("set_b")
    fits = (100 * of_a >= percent * of_b) & (100 * of_b >= percent * of_a)
    return (
        pairs.join(one, "a").join(two, "b").where(fits)
        .where(100 * both >= percent * (of_a + of_b - both)).select("a", "b")
    )


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with the sets ``right``."""
    if len(left) * len(right) <= 64:
        return np.array([
            [len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in right]
            for i in left
        ])
    # As products of 0/1 matrices over the values that occur twice, some columns at a time.
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, value, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    twice = count[value] > 1
    rows, columns = rows[twice], number[value[twice]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(columns[-1]) + 1 if len(columns) else 0, _COLUMNS):
        low, high = np.searchsorted(columns, [start, start + _COLUMNS])
        dense = np.zeros((len(sets), _COLUMNS), np.float32)
        dense[rows[low:high], columns[low:high] - start] = 1
        total += dense[left] @ dense[right].T
    return total.astype(np.int64)


def _block_links(members: pa.Table, percent: int) -> pa.Table:
    """Links (a, b) that join the clusters' nodes of one block pair, without those that close a cycle.

    Only pairs that share a table are linked, whether the groups are clusters or tables.
    """
    members = members.combine_chunks()
    nodes = members.column("node").to_pylist()
    side = members.column("side").to_numpy()
    group = members.column("group").to_numpy()
    column = members.column("set").chunk(0) if members.num_rows else None
    offsets = column.offsets.to_numpy() if column is not None else None
    values = column.values.to_numpy() if column is not None else None
    buckets = members.column("buckets").chunk(0) if members.num_rows else None
    bounds = buckets.offsets.to_numpy() if buckets is not None else None
    tables = buckets.values.to_numpy() if buckets is not None else None
    pairs = []
    for g in np.unique(group):
        at = np.flatnonzero(group == g)
        sets = [values[offsets[i] : offsets[i + 1]] for i in at]
        sizes = np.array([len(x) for x in sets])
        left, right = np.flatnonzero(side[at] <= 1), np.flatnonzero(side[at] != 1)
        # A block that no node fell into.
        if not len(left) or not len(right):
            continue
        both = _shared(sets, left, right)
        union = sizes[left][:, None] + sizes[right][None, :] - both
        found = np.argwhere(100 * both >= percent * union)
        leader = np.arange(len(at))
        own = [tables[bounds[i] : bounds[i + 1]] for i in at]
        for x, y in zip(left[found[:, 0]], right[found[:, 1]]):
            first, second = x, y
            while leader[x] != x:
                leader[x] = x = leader[leader[x]]
            while leader[y] != y:
                leader[y] = y = leader[leader[y]]
            if x != y and np.isin(own[first], own[second], assume_unique=True).any():
                leader[max(x, y)] = min(x, y)
                pairs.append((nodes[at[first]], nodes[at[second]]))
    return pa.table({
        "a": pa.array([a for a, _ in pairs], pa.binary()),
        "b": pa.array([b for _, b in pairs], pa.binary()),
    })


def near_duplicates(
    docs: DataFrame, id_column: str, text: str = "text", n: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id, kept, text_hash) of each row: its near-duplicate class.

    Sets of distinct n-word shingles (all words as one shingle if there are fewer), linked where
    100 * intersection >= percent * union. The class is named by its smallest id, and the row
    that has this id is kept. Null, empty or blank texts have no shingles, are linked with
    nothing and stay. Rows with a null id are linked like others; their class has the smallest
    id that is not null, and if it has none they stay. Rows that repeat an id are all marked
    alike: repeated rows are equal texts, so a plan that keeps one row must drop them by itself.
    text_hash, the text's xxhash64, tells rows of one id (or of none) with different texts apart.
    """
    source = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    signatures = written(_signatures(source, n), "signatures")
    nodes = signatures.where("node is not null")
    # One row per distinct set; copies are combined before the shuffle.
    first = nodes.groupBy("node").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    one_each = nodes.dropDuplicates(["node"])
    tables = written(_tables(one_each), "tables")

    wanted = tables.select("node").distinct()
    ids = signatures.select("id", "node").join(wanted, "node", "left_semi").select("id")
    ids = ids.groupBy("id").count().select(F.col("id").alias("wanted_id"))
    again = source.join(ids, F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi")
    sets = _sets(again.select("text"), n)
    sets = written(
        sets.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "sets"
    )

    # Clusters: the nodes of a table hang on its smallest one.
    heads = tables.groupBy("bucket").agg(F.min("node").alias("head"))
    hung = tables.join(heads, "bucket").select(F.col("head").alias("a"), F.col("node").alias("b"))
    clusters = components(hung)
    to_pivot = clusters.where("node <> root").select(
        F.col("root").alias("a"), F.col("node").alias("b")
    )
    links = written(_confirmed(to_pivot, sets, percent), "confirmed")

    # Who is linked to the pivot, or is it, needs no comparison with its like.
    linked = links.select(F.col("b").alias("node"), F.lit(True).alias("linked"))
    members = clusters.join(linked, "node", "left").select(
        F.xxhash64("root").alias("group"), "node",
        (F.coalesce("linked", F.lit(False)) | (F.col("node") == F.col("root"))).alias("main"),
    )
    open_ = members.groupBy("group").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("main"), 0).otherwise(1)).alias("others")
    ).where("others > 0 and n > 2")
    members = written(members.join(open_, "group"), "open")
    big = members.where(f"others > {LARGE}").select("node", "main")
    members = members.where(f"others <= {LARGE}").select("group", "node", "main").unionByName(
        tables.join(big, "node").select(F.col("bucket").alias("group"), "node", "main")
    )
    members = written(members, "members")
    own_tables = tables.join(members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.collect_set("bucket").alias("buckets")
    )
    own_sets = sets.join(own_tables, "node")
    bins = 1 + members.count() // BLOCK
    rows = block_pairs(members, BLOCK, bins).join(own_sets, "node")
    more = rows.groupBy("unit").applyInArrow(
        lambda table: _block_links(table, percent), "a binary, b binary"
    )
    links = links.union(written(more, "links"))
    roots = components(links)

    named = first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = named.groupBy("root").agg(F.min("first").alias("class"), F.sum("copies").alias("of"))
    named = named.join(classes.where("of > 1"), "root").select("node", "class")
    marked = signatures.join(named, "node", "left")
    component = F.when(F.col("class").isNotNull(), F.col("class")).otherwise(F.col("id"))
    return marked.select(
        F.col("id").alias(id_column),
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
        F.col("hash").alias("text_hash"),
    )
