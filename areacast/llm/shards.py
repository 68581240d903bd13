"""Sharding by a two-pass external shuffle.

First pass: a seeded hash of the id scatters the records uniformly over buckets, so many that each fits into
memory. Second pass: each bucket is put in a fixed order by a window, its ranks are shuffled by
Fisher-Yates with a seed of its own, and a join gives each record its place in its shard. Only the ranks of a
bucket are held in Python, never its records.

The law is ``key``: id and shard count decide. A record goes to the shard whose hash with the id is the highest, so
one more shard takes records from all others and no record moves between the old ones.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKET_BYTES = 32_000_000
# Ranks and slots of a bucket are sent in pieces of so many.
_CHUNK = 1 << 20


def shard_of(id_column: str, shards: int, seed: int = 7) -> Column:
    """The shard of an id; null ids are one key."""
    heights = [
        F.struct(F.xxhash64(F.lit(seed), F.col(id_column), F.lit(s)).alias("h"), F.lit(s).alias("s"))
        for s in range(shards)
    ]
    return (heights[0] if shards == 1 else F.greatest(*heights))["s"]


def record_size(text: str) -> Column:
    """UTF-8 bytes of the text and one more."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def shuffled(
    docs: DataFrame, id_column: str, shards: int, text: str = "text", seed: int = 7,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All records with ``_shard`` and ``_slot``, their place in the shard from 0 on without gaps.

    Columns of these names are replaced.
    Reruns agree whatever the order and partitioning of the records. Records with equal ids are of one shard and
    are spread over its buckets by their text and ordered by all columns; wholly equal ones are interchangeable. Null ids are a key like
    others, null and empty texts are records like others, and no records give none.
    """
    columns = [c for c in docs.columns if c.lower() not in ("_shard", "_slot")]
    own = shard_of(id_column, shards, seed)
    # As many buckets as a shard's bytes ask for: a hot id makes its shard larger, not its buckets.
    measured = docs.groupBy(own.alias("shard")).agg(F.sum(record_size(text)).alias("n")).collect()
    numbers = {row["shard"]: -(-row["n"] // bucket_bytes) for row in measured}
    buckets = F.get(F.array(*[F.lit(numbers.get(s, 1)) for s in range(shards)]), F.col("_shard"))
    spread = F.xxhash64(F.lit(seed + 1), F.col(id_column), F.col(text))
    # Rows of equal id and text are told apart by their other columns.
    values = [
        F.to_json(f"`{c}`") if "map<" in docs.schema[c].dataType.simpleString() else F.col(f"`{c}`") for c in columns
    ]
    everything = F.xxhash64(F.lit(seed + 2), *values, *[v.isNull() for v in values])
    placed = docs.select(
        *columns, own.alias("_shard"), spread.alias("_shard_order"), everything.alias("_shard_all"),
    ).withColumn("_shard_bucket", F.pmod(F.col("_shard_order"), buckets).cast("int"))
    # Where each bucket starts in its shard.
    sizes = placed.groupBy("_shard", "_shard_bucket").agg(F.count("*").alias("_shard_n"))
    before = Window.partitionBy("_shard").orderBy("_shard_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        "_shard", "_shard_bucket", "_shard_n",
        F.coalesce(F.sum("_shard_n").over(before), F.lit(0)).alias("_slot"),
    )
    # A record's rank in its bucket: by the order, null ids last among equal ones, then by all columns.
    rank = F.row_number().over(
        Window.partitionBy("_shard", "_shard_bucket").orderBy(
            "_shard_order", F.col(id_column).isNull(), "_shard_all"
        )
    ) - 1
    ranked = placed.withColumn("_shard_rank", rank.cast("bigint"))

    def slots(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(bucket, rank, slot): the ranks of each bucket in the order of a seeded Fisher-Yates shuffle."""
        for batch in rows:
            for row in batch.to_pylist():
                shard, number, n = row["_shard"], row["_shard_bucket"], row["_shard_n"]
                # Shuffles the ranks as it would the records: the draws depend on the count alone.
                order = np.arange(n, dtype=np.int64)
                draw = np.random.Generator(np.random.PCG64([seed, shard, number]))
                draw.shuffle(order)
                for begin in range(0, n, _CHUNK):
                    part = order[begin:begin + _CHUNK]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(part), shard), pa.int32()),
                        pa.array(np.full(len(part), number), pa.int32()),
                        pa.array(part, pa.int64()),
                        pa.array(np.arange(begin, begin + len(part)) + row["_slot"], pa.int64()),
                    ], names=["_shard", "_shard_bucket", "_shard_rank", "_slot"])

    # Buckets spread over as many tasks as a shuffle has, or one task each where they are fewer.
    limit = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(sum(numbers.values()), limit))
    placed_slots = starts.repartition(parts, "_shard", "_shard_bucket").mapInArrow(
        slots, "_shard int, _shard_bucket int, _shard_rank bigint, _slot bigint"
    )
    # The ranks grow with the records: joined by a shuffle, never broadcast.
    return ranked.join(placed_slots.hint("merge"), ["_shard", "_shard_bucket", "_shard_rank"]).select(
        *columns, "_shard", "_slot"
    )


def write_shards(records: DataFrame, path: str) -> None:
    """Write the records of :func:`shuffled` as one folder per shard; a file holds runs of slots in order."""
    records.sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)
