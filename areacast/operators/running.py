"""Running totals over a sorted table without gathering it in one task.

A window without partition columns would sort everything in a single task. Here the rows
are range-partitioned and written once with their partition number; the totals of the
partitions, a table with one row per partition and group, give each partition its start,
and the running total within a partition is a window over that partition alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from areacast.sources.tables import written


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column],
    totals: dict[str, str],
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums: ``totals`` maps a value column to its new column.

    ``order_by`` has to order the rows of a group without ties. Each sum starts anew per
    group. Rows that tie on a hot value are still split, since ``order_by`` tells them apart.
    """
    groups = [F.col(g) for g in group_by]
    placed = written(
        df.repartitionByRange(*groups, *order_by).withColumn("_part", F.spark_partition_id()),
        "sorted",
    )
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = placed.groupBy(*group_by, "_part").agg(
        *[F.sum(value).alias(f"_sum_{out}") for value, out in totals.items()]
    )
    starts = starts.select(
        *[F.col(g).alias(f"_start_{g}") for g in group_by],
        F.col("_part").alias("_start_part"),
        *[
            F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_start_{out}")
            for out in totals.values()
        ],
    )
    within = Window.partitionBy(*groups, "_part").orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = placed.withColumns({
        f"_run_{out}": F.sum(value).over(within) for value, out in totals.items()
    })
    match = [F.col("_part") == F.col("_start_part")]
    match += [F.col(g).eqNullSafe(F.col(f"_start_{g}")) for g in group_by]
    joined = summed.join(starts, match, "left").withColumns({
        out: F.col(f"_start_{out}") + F.col(f"_run_{out}") for out in totals.values()
    })
    return joined.select(*df.columns, *totals.values())
