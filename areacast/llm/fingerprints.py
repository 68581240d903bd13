"""Fingerprints of documents by MinHash, and the near-duplicates that they find.

A fingerprint is the 16 low bits of 128 minima: each of the 128 functions, h(x) = (a * x + b) mod (2^31 - 1) with random a > 0 and b, permutes the
numbers below that prime, and its minimum is taken over the shingles of a text, all functions of a text as one numpy matrix. Two sets of
similarity s agree in each value with probability s (and 2^-16 of the rest), so the share of equal values is an estimate of it.

Near-duplicates: 32 bands of 4 values are the keys by which Spark brings documents together; two of
similarity 0.8 share one with probability 1 - (1 - 0.8^4)^32, all but one in 20 million. Pairs are verified on full sets. Documents of equal sets are one node.
In a bucket all nodes are first compared with one of them; those linked to it need no comparison with each other. The others
meet all nodes of the bucket block by block, in tasks that return links only.

Edited texts: documents follow each other by id over range partitions, so every row but the last of a partition finds the next one beside it. The last
rows, one per partition, are joined with the first row of the partition after theirs.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from areacast.llm import words
from areacast.llm.blocks import block_pairs
from areacast.llm.graph import components
from areacast.sources.tables import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VALUES, BAND, SEED, N = 128, 4, 11, 5
PRIME = (1 << 31) - 1
BLOCK = 256
# Shingles at a time: their products with all functions stay in the processor's cache.
_CHUNK = 256


class Hasher:
    """The hash functions, and the word hashes that a task remembers."""

    def __init__(self, n: int = N, values: int = VALUES, seed: int = SEED):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.n, self.values = n, values
        self.a = draw.integers(1, PRIME, values, dtype=np.uint64)[:, None]
        self.b = draw.integers(0, PRIME, values, dtype=np.uint64)[:, None]
        self.ids = words.WordIds()

    def shingles(self, text: bytes | None) -> np.ndarray:
        """The sorted hashes of the distinct shingles of n words."""
        return words.shingle_set(self.ids.of(words.spaced_words(text)), self.n)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        """The 16 low bits of each function's minimum; nothing for an empty set."""
        if not len(hashes):
            return np.empty(0, np.uint16)
        prime, bits = np.uint64(PRIME), np.uint64(31)
        numbers = (hashes >> np.uint64(33)) % prime
        least = None
        for start in range(0, len(numbers), _CHUNK):
            product = self.a * numbers[start : start + _CHUNK]
            product += self.b
            # Modulo 2^31 - 1: the high bits count as much as the low ones; the prime stands for 0.
            high = product >> bits
            product &= prime
            product += high
            folded = product.astype(np.uint32)
            over = folded >> np.uint32(31)
            folded &= np.uint32(PRIME)
            folded += over
            own = folded.min(axis=1)
            least = own if least is None else np.minimum(least, own)
        return (least & np.uint32(0xFFFF)).astype(np.uint16)

    def fingerprint(self, text: str | None) -> np.ndarray:
        return self.minima(self.shingles((text or "").encode()))


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Share of equal values; texts without words are like each other and like nothing else."""
    if len(one) != len(two):
        return 0.0
    return float((one == two).mean()) if len(one) else 1.0


def packed(fingerprint: np.ndarray) -> bytes:
    return fingerprint.astype(">u2").tobytes()


def _text_rows(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )


def fingerprints(docs: DataFrame, id_column: str, text: str = "text", n: int = N) -> DataFrame:
    """(id, n_shingles, fingerprint) of each row: lower-case hex, 4 digits a value.

    Shingles are n words between white space, A-Z in lower case; all words if there are fewer. Null, empty and blank texts have an empty
    fingerprint. Equal texts have equal fingerprints.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(n)
        for batch in batches:
            sets = [hasher.shingles(t) for t in words.texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, sets), pa.int64()),
                 pa.array([packed(hasher.minima(s)).hex() for s in sets], pa.string())],
                ["id", "n_shingles", "fingerprint"],
            )

    found = _text_rows(docs, id_column, text).mapInArrow(
        run, "id bigint, n_shingles bigint, fingerprint string"
    )
    return found.withColumnRenamed("id", id_column)


def edited_text(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by the first ones of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_EDITED = (
    "id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary,"
    " near_edited double, near_next double"
)


class _Edits:
    """Result rows of documents and their following ones, gathered to a batch."""

    def __init__(self, hasher: Hasher):
        self.hasher, self.rows = hasher, []

    def add(self, id_, text: str, own: np.ndarray, following: str, other: np.ndarray) -> None:
        edited = edited_text(text, following)
        changed = own if edited == text else self.hasher.fingerprint(edited)
        self.rows.append((
            id_, len(text), hashlib.sha256(edited.encode()).digest(), packed(own), packed(changed),
            likeness(own, changed), likeness(own, other),
        ))

    def batch(self) -> list[pa.Array]:
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 3, *[pa.float64()] * 2]
        columns = zip(*self.rows) if self.rows else [()] * len(kinds)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        self.rows = []
        return arrays


def edited_fingerprints(docs: DataFrame, id_column: str, text: str = "text", n: int = N) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The edited text has its last half replaced by as many first code points of the next document (all if it has
    fewer); the first document follows the last. Documents follow by ascending id, null ids last, those of one id by the xxhash64 of their text; a single
    document follows itself. Repeated rows are rows of their own, each followed by the next one. Null counts as the empty text. Fingerprints are
    those of :func:`fingerprints`, ``near_edited`` and ``near_next`` the share of values that the
    fingerprint has in common with that of the edited text and of the next document. An empty table gives no rows.
    """
    # The row's number tells equal rows apart, so that a hot one is dealt to several partitions as well.
    keys = [F.col("id").asc_nulls_last(), F.xxhash64("text"), F.col("_row")]
    ordered = _text_rows(docs, id_column, text).withColumn("_row", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).select("id", "text")
    edges = [("part", pa.int32()), ("first", pa.string()), ("last", pa.string())]
    names = [c.split()[0] for c in _EDITED.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(n)
        edits = _Edits(hasher)
        first = before = None
        for batch in batches:
            for id_, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = hasher.fingerprint(own)
                if before is None:
                    first = own
                else:
                    edits.add(*before, own, found)
                before = id_, own, found
            columns = edits.batch()
            yield pa.RecordBatch.from_arrays(
                [*columns, *[pa.nulls(len(columns[0]), kind) for _, kind in edges]],
                [*names, *[name for name, _ in edges]],
            )
        if before is not None:
            own = [[before[0]], *[[None]] * (len(names) - 1)]
            edge = [[TaskContext.get().partitionId()], [first], [before[1]]]
            kinds = [*[c.type for c in _Edits(hasher).batch()], *[kind for _, kind in edges]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip([*own, *edge], kinds)],
                [*names, *[name for name, _ in edges]],
            )

    found = written(
        ordered.mapInArrow(run, f"{_EDITED}, part int, first string, last string"), "edited"
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(n)
        edits = _Edits(hasher)
        for batch in batches:
            for id_, own, following in zip(*[c.to_pylist() for c in batch.columns]):
                edits.add(id_, own, hasher.fingerprint(own), following, hasher.fingerprint(following))
            yield pa.RecordBatch.from_arrays(edits.batch(), names)

    ends = found.where("part is not null")
    # Numbers of partitions only: the next one that has rows, or the first.
    order = Window.orderBy("part")
    around = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = ends.select("part").select(
        F.col("part").alias("_of"),
        F.coalesce(F.lead("part").over(order), F.first("part").over(around)).alias("_next"),
    )
    following = ends.select(F.col("part").alias("_next"), F.col("first").alias("following"))
    closed = ends.join(after, F.col("part") == F.col("_of")).join(following, "_next")
    closed = closed.select("id", "last", "following").mapInArrow(close, _EDITED)
    rows = found.where("part is null").select(*names).unionByName(closed)

    def hexed(name: str):
        return F.lower(F.hex(name)).alias(name)

    return rows.select(
        F.col("id").alias(id_column), "n_chars", hexed("edited_sha256"), hexed("fingerprint"),
        hexed("edited_fingerprint"), "near_edited", "near_next",
    )


def _signed(docs: DataFrame, n: int) -> DataFrame:
    """(id, hash, size, node, bands): node is the digest of the set, null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(n)
        for batch in batches:
            sets = [hasher.shingles(t) for t in words.texts(batch.column(1))]
            nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            # Four values of 16 bits are one key as they stand.
            bands = [hasher.minima(s).view(np.int64) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(map(len, sets), pa.int64()),
                 pa.array(nodes, pa.binary()), words.lists(bands, pa.int64())],
                ["id", "hash", "size", "node", "bands"],
            )

    return docs.withColumn("hash", F.xxhash64("text")).mapInArrow(
        run, "id bigint, hash bigint, size bigint, node binary, bands array<bigint>"
    )


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """(node, set) of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(n)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                sets = [hasher.shingles(t) for t in words.texts(batch.column(0).slice(start, BLOCK))]
                nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.binary()), words.lists([s.view(np.int64) for s in sets], pa.int64())],
                    ["node", "set"],
                )

    return docs.mapInArrow(run, "node binary, set array<bigint>")


def _links(unit: pa.Table, percent: int) -> pa.Table:
    """Verified links (a, b) of one unit: its groups' nodes of the left side with those of the right side."""
    nodes, sides, groups = (unit.column(c).to_pylist() for c in ("node", "side", "group"))
    sets = [np.sort(np.array(s, np.int64)) for s in unit.column("set").to_pylist()]
    found = []
    for group in sorted(set(groups)):
        left = [i for i, g in enumerate(groups) if g == group and sides[i] <= 1]
        right = [i for i, g in enumerate(groups) if g == group and sides[i] != 1]
        if not left or not right:
            continue
        sizes = np.array([len(sets[i]) for i in right])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        flat = np.concatenate([sets[i] for i in right])
        for i in left:
            both = np.add.reduceat(np.isin(flat, sets[i]).astype(np.int64), starts)
            union = sizes + len(sets[i]) - both
            found += [
                (nodes[i], nodes[right[j]])
                for j in np.flatnonzero(100 * both >= percent * union) if nodes[i] != nodes[right[j]]
            ]
    return pa.table({
        "a": pa.array([a for a, _ in found], pa.binary()),
        "b": pa.array([b for _, b in found], pa.binary()),
    })


def near_duplicates(
    docs: DataFrame, id_column: str, text: str = "text", n: int = N, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id, kept, text_hash) of each row: its class of near-duplicates.

    Linked are documents that share a band and whose full sets of shingles have 100 * intersection >= percent * union; at 80 or more the
    bands find all but one pair in 20 million. A class has the smallest id of its rows that is not null, null if
    there is none. Kept is its first row by id and xxhash64 of the text; rows equal in both are marked alike.
    Texts without words are linked with nothing and are all kept. An empty table gives no rows.
    """
    source = _text_rows(docs, id_column, text)
    signed = written(_signed(source, n), "signed")
    nodes = signed.where("node is not null")
    first = nodes.groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("first")
    )
    keys = nodes.dropDuplicates(["node"]).select("node", F.posexplode("bands").alias("band", "key"))
    keys = keys.select("node", F.xxhash64("band", "key").alias("bucket"))
    heads = keys.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("nodes"))
    members = written(
        keys.join(heads.where("nodes > 1"), "bucket").select("bucket", "node", "head"), "buckets"
    )
    wanted = members.select("node").distinct()
    texts = signed.join(wanted, "node", "left_semi").groupBy("id", "hash").agg(F.min("node").alias("_node"))
    again = source.withColumn("_hash", F.xxhash64("text")).join(
        texts.select(F.col("id").alias("_id"), F.col("hash").alias("_h")),
        F.col("id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left_semi",
    )
    sets = written(_sets(again.select("text"), n).dropDuplicates(["node"]), "sets")

    def of(side: str) -> DataFrame:
        return sets.select(F.col("node").alias(side), F.col("set").alias(f"set_{side}"))

    both = F.size(F.array_intersect("set_a", "set_b"))
    to_head = members.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    linked = to_head.distinct().join(of("a"), "a").join(of("b"), "b").where(
        100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)
    )
    linked = written(linked.select("a", "b"), "to_heads")

    known = linked.select(F.col("a").alias("head"), F.col("b").alias("node"), F.lit(True).alias("known"))
    marked = members.join(known, ["head", "node"], "left").select(
        F.col("bucket").alias("group"), "node",
        (F.coalesce("known", F.lit(False)) | (F.col("node") == F.col("head"))).alias("main"),
    )
    open_ = marked.groupBy("group").agg(
        F.count("*").alias("nodes"), F.sum(F.when(F.col("main"), 0).otherwise(1)).alias("others")
    ).where("others > 0 and nodes > 2")
    marked = written(marked.join(open_, "group").select("group", "node", "main"), "open")
    units = block_pairs(marked, BLOCK, 1 + marked.count() // BLOCK).join(sets, "node")
    more = units.groupBy("unit").applyInArrow(
        lambda table: _links(table, percent), "a binary, b binary"
    )
    links = linked.unionByName(written(more, "more_links"))
    roots = components(links)
    named = first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = named.groupBy("root").agg(F.min("first").alias("least"))
    named = named.join(classes, "root").select("node", "least")
    found = signed.join(named, "node", "left")
    alone = F.col("least").isNull()
    return found.select(
        F.col("id").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("least.id")).alias("component_id"),
        (alone | (F.col("id").eqNullSafe(F.col("least.id")) & (F.col("hash") == F.col("least.hash")))).alias("kept"),
        F.col("hash").alias("text_hash"),
    )
