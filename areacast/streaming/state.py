"""What has arrived so far, as a table of mergeable partials that grows by batches.

A batch adds its partials to those of the weeks it touches and writes the sums as a new generation of these weeks: the folder has a
partition per week and generation, numbered by the batch. The state of a week is its newest generation. A batch that is repeated reads
what was there before it and replaces its own generation, so running twice leaves what running once does, and a
batch that is cut off anywhere leaves the older generation as it is. Only a week's last two generations are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.operators.partials import merged, partial_columns
from areacast.sources.tables import (
    distinct_values,
    drop_partition,
    folder_exists,
    one_of,
    overwrite_partitions,
    written,
)

GENERATION = "generation"


def latest(
    spark: SparkSession,
    path: str,
    schema: str,
    week: str,
    weeks: Sequence | None = None,
    before: int | None = None,
) -> DataFrame:
    """The partials of the listed weeks, or of all, as they were before a batch, or as they are.

    Weeks and generations are partitions, so nothing else is read.
    """
    if not folder_exists(spark, path):
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(f"{schema}, {GENERATION} bigint").parquet(path)
    if weeks is not None:
        stored = stored.where(one_of(week, weeks))
    if before is not None:
        stored = stored.where(F.col(GENERATION) < before)
    newest = stored.groupBy(F.col(week).alias("_week")).agg(F.max(GENERATION).alias("_newest"))
    same = F.col(week).eqNullSafe(F.col("_week")) & (F.col(GENERATION) == F.col("_newest"))
    return stored.join(newest, same).drop("_week", "_newest", GENERATION)


def advance(
    new: DataFrame, path: str, keys: Sequence[str], week: str, measures: Sequence[str], number: int
) -> list:
    """Add the partials of batch ``number``; gives the weeks that it touches."""
    spark = new.sparkSession
    columns = [*[k for k in keys if k != week], *partial_columns(measures), week]
    new = written(new.select(*columns), "batch")
    weeks = distinct_values(new, week)
    if not weeks:
        return []
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema.fields)
    before = latest(spark, path, schema, week, weeks, before=number)
    sums = merged(before.unionByName(new), keys, measures).select(*columns)
    sums = written(sums.withColumn(GENERATION, F.lit(number).cast("bigint")), "state")
    overwrite_partitions(sums.repartition(week), path, [week, GENERATION])
    _forget(spark, path, schema, week, weeks, number)
    return weeks


def _forget(
    spark: SparkSession, path: str, schema: str, week: str, weeks: Sequence, number: int
) -> None:
    """Drop the generations of the weeks that are older than the one before this batch's."""
    stored = spark.read.schema(f"{schema}, {GENERATION} bigint").parquet(path)
    older = stored.where(one_of(week, weeks)).where(F.col(GENERATION) < number)
    # One row per partition folder of the touched weeks.
    found = older.select(week, GENERATION).distinct().collect()
    newest: dict = {}
    for value, generation in found:
        newest[value] = max(generation, newest.get(value, generation))
    for value, generation in found:
        if generation < newest[value]:
            drop_partition(spark, path, [(week, value), (GENERATION, generation)])
