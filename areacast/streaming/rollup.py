"""Weekly aggregate of arriving observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _monday_week(ts: str) -> Column:
    # Windows are aligned to 1970-01-01, a Thursday; four days on is a Monday.
    return F.window(F.col(ts), "7 days", startTime="4 days")


def weekly_rollup(
    observations: DataFrame,
    ts: str,
    keys: Sequence[str],
    measures: Sequence[str],
    delay: str | None = "1 day",
    count: str = "n_observations",
) -> DataFrame:
    """Count and means per key and Monday-to-Sunday week; batch or stream.

    On a stream in append mode a week appears once the watermark has passed its end; the
    state holds the open weeks only. A batch gives all weeks. Watermarks need a time with a
    zone, so a time without one is taken in the session's zone, which should be UTC.
    """
    if observations.isStreaming and delay:
        zoned = observations.withColumn(ts, F.col(ts).cast("timestamp"))
        observations = zoned.withWatermark(ts, delay)
    grouped = observations.groupBy(_monday_week(ts).alias("week"), *keys).agg(
        F.count(F.lit(1)).alias(count), *[F.avg(m).alias(m) for m in measures]
    )
    return grouped.select(
        F.to_date(F.col("week.start")).alias("week_start"), *keys, count, *measures
    )
