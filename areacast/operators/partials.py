"""Mergeable sums of rows per key, and the base that follows from them.

A partial stands for the rows of its key: their number, and per measure the sum and the number of the given values. Partials of the same
key add up, in any order and number, and a mean after imputation follows from them exactly: the missing values of a key are as many
times the mean that fills them. So rows can be summed before a join multiplies them, and arrivals can be added to what
is known already without reading it again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areacast.operators.aggregate import encoded_stations
from areacast.operators.clean import given, mean_columns

ROWS = "n_rows"


def sum_of(measure: str) -> str:
    return f"sum_{measure}"


def given_of(measure: str) -> str:
    return f"given_{measure}"


def partial_columns(measures: Sequence[str], rows: str = ROWS) -> list[str]:
    return [rows, *[name(m) for m in measures for name in (sum_of, given_of)]]


def partials(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], rows: str = ROWS
) -> DataFrame:
    """One row per key; NaN counts as missing."""
    sums = [
        column
        for m in measures
        for column in (
            F.coalesce(F.sum(given(m)), F.lit(0.0)).alias(sum_of(m)), F.count(given(m)).alias(given_of(m))
        )
    ]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows), *sums)


def merged(
    parts: DataFrame, keys: Sequence[str], measures: Sequence[str], rows: str = ROWS
) -> DataFrame:
    """Partials of the same key as one."""
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in partial_columns(measures, rows)])


def means_of(
    parts: DataFrame, measures: Sequence[str], constants: Sequence[str] = (), rows: str = ROWS
) -> DataFrame:
    """One row with the mean over the rows that the partials stand for.

    ``constants`` are columns with one value for all rows of a partial.
    """

    def of_constant(name: str) -> Column:
        weight = F.when(given(name).isNotNull(), F.col(rows))
        return F.sum(given(name) * F.col(rows)) / F.sum(weight)

    of_measures = [
        (F.sum(sum_of(m)) / F.nullif(F.sum(given_of(m)), F.lit(0))).alias(m) for m in measures
    ]
    return parts.agg(*[of_constant(c).alias(c) for c in constants], *of_measures)


def base_of_partials(
    parts: DataFrame,
    area: str,
    week: str,
    station: str,
    measures: Sequence[str],
    constants: Sequence[str],
    stations: Mapping[str, str],
    means: DataFrame | Mapping[str, float] | None = None,
    label: str = "n_observations",
    encoding: str = "count",
    rows: str = ROWS,
) -> DataFrame:
    """Number of rows, means after imputation and station columns per area and week.

    The same as imputing the rows and grouping them by :func:`aggregate.model_base`. The means that fill gaps are those
    of the partials themselves unless given; a column with gaps and no value at all raises an error that names it.
    """
    names = [*constants, *measures]
    own = means_of(parts, measures, constants, rows) if means is None else means
    fill = mean_columns(own, names)
    # Totals over the rows of each partial, gaps filled.
    total = {c: F.col(rows) * F.coalesce(given(c), fill[c]) for c in constants}
    for m in measures:
        missing = F.col(rows) - F.col(given_of(m))
        total[m] = F.col(sum_of(m)) + F.when(missing > 0, missing * fill[m]).otherwise(F.lit(0.0))
    totals = parts.withColumns({f"_total_{n}": total[n] for n in names})
    weekly = totals.groupBy(area, week).agg(
        F.sum(rows).cast("bigint").alias(label),
        *[(F.sum(f"_total_{n}") / F.sum(rows)).alias(n) for n in names],
        *[F.sum(F.when(F.col(station) == v, F.col(rows))).alias(n) for v, n in stations.items()],
    )
    return encoded_stations(weekly, area, label, stations, encoding)
