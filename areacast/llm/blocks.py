"""Groups of nodes cut into pairs of blocks, so that no task holds a group and no pair is a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(members: DataFrame, size: int, bins: int | None = None) -> DataFrame:
    """Rows (unit, side, group, node): what is compared in one task.

    ``members`` has (group, node, main): main nodes need no comparison with each other, and groups of
    main nodes only have no unit. A group of at most ``size`` nodes is one unit (side 0: all with all); with
    ``bins``, several such groups share one of so many units. Larger ones are cut into blocks: a
    pair of blocks is a unit, side 1 against side 2 (a block with itself: side 0); two blocks of main nodes are no pair.
    """
    sizes = members.groupBy("group").agg(
        F.sum(F.when(F.col("main"), 1).otherwise(0)).alias("mains"), F.count("*").alias("nodes")
    ).where("nodes > mains")
    placed = members.join(sizes, "group")
    small = placed.where(f"nodes <= {size}").withColumn("side", F.lit(0)).withColumn(
        "unit", F.xxhash64("group" if bins is None else F.pmod("group", F.lit(bins)))
    )
    others = F.ceil((F.col("nodes") - F.col("mains")) / size)
    count = F.when(F.col("main"), F.ceil(F.col("mains") / size)).otherwise(others)
    block = F.pmod(F.xxhash64("node", F.lit("block")), F.greatest(count, F.lit(1)))
    large = placed.where(f"nodes > {size}").withColumn("block", block)
    all_others = F.sequence(F.lit(0).cast("bigint"), others - 1)
    all_mains = F.when(
        F.col("mains") > 0,
        F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("mains") / size) - 1),
    ).otherwise(F.array().cast("array<bigint>"))

    def pair(one, kind, two, side):
        return F.struct(
            F.xxhash64("group", one, F.lit(kind), two).alias("unit"), side.alias("side")
        )

    own = F.col("block")
    with_others = F.transform(all_others, lambda j: pair(
        F.least(own, j), "others", F.greatest(own, j),
        F.when(own == j, 0).when(own < j, 1).otherwise(2),
    ))
    with_mains = F.transform(all_mains, lambda k: pair(own, "mains", k, F.lit(1)))
    as_main = F.transform(all_others, lambda i: pair(i, "mains", own, F.lit(2)))
    at = F.when(F.col("main"), as_main).otherwise(F.concat(with_others, with_mains))
    large = large.withColumn("at", F.explode(at))
    columns = ["unit", "side", "group", "node"]
    return small.select(*columns).unionByName(
        large.select("at.unit", "at.side", "group", "node")
    )
