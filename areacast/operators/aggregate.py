"""Grouping case rows to (area, week), and the two station encodings.

Every function takes an optional ``weight``: a column that says how many rows a row
stands for. :func:`collapse` makes such rows. Its partial aggregation runs before the
shuffle, so a hot area or the missing area shrinks to its distinct keys on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from areacast.fixed import STATIONS


def _rows(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight).cast("bigint")


def _mean(name: str, weight: str | None) -> Column:
    if weight is None:
        return F.avg(name)
    given = F.when(F.col(name).isNotNull(), F.col(weight))
    return F.sum(F.col(name) * F.col(weight)) / F.sum(given)


def collapse(df: DataFrame, keys: Sequence[str], weight: str = "n_rows") -> DataFrame:
    """Equal keys become one row with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(weight))


def area_week_base(
    df: DataFrame,
    area: str,
    week: str,
    measures: Sequence[str],
    label: str = "resposta",
    weight: str | None = None,
) -> DataFrame:
    """Number of rows and mean of each measure per area and week."""
    return df.groupBy(area, week).agg(
        _rows(weight).alias(label), *[_mean(m, weight).alias(m) for m in measures]
    )


def area_station_count(
    df: DataFrame, area: str, station: str, count: str = "qtd", weight: str | None = None
) -> DataFrame:
    """Number of rows per area and station."""
    return df.groupBy(area, station).agg(_rows(weight).cast("int").alias(count))


def station_pivot(
    counts: DataFrame,
    area: str,
    station: str,
    count: str = "qtd",
    stations: Mapping[str, str] = STATIONS,
) -> DataFrame:
    """One row per area, one column per declared station holding its count.

    The list of stations is given, so the pivot runs no job to find them and the schema
    does not depend on the data. Stations that do not occur give null.
    """
    wide = counts.groupBy(area).pivot(station, list(stations)).agg(F.avg(count))
    return wide.withColumnsRenamed(dict(stations))


def attach_station_counts(
    base: DataFrame, pivot: DataFrame, area: str, columns: Sequence[str]
) -> DataFrame:
    """The base with the station columns of its area; missing counts are 0."""
    return base.join(pivot, area, "left").fillna(0, subset=list(columns))


def station_share(
    df: DataFrame,
    area: str,
    week: str,
    station: str,
    stations: Mapping[str, str] = STATIONS,
    weight: str | None = None,
) -> DataFrame:
    """Share of the rows of each area and week that belong to each declared station."""
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    one = F.lit(1) if weight is None else F.col(weight)
    return df.groupBy(area, week).agg(*[
        (F.sum(F.when(F.col(station) == value, one).otherwise(F.lit(0))) / total).alias(name)
        for value, name in stations.items()
    ])


def model_base(
    df: DataFrame,
    area: str,
    week: str,
    station: str,
    measures: Sequence[str],
    label: str = "resposta",
    stations: Mapping[str, str] = STATIONS,
    weight: str | None = None,
    encoding: str = "count",
) -> DataFrame:
    """Area-week base with the station columns, from one pass over the rows.

    ``count``: the station counts of the area over all weeks, the same result as
    ``attach_station_counts(area_week_base, station_pivot)``. The counts are taken per area and week together
    with the means and summed over the weeks of the area in a window, so the rows are read
    once. A window partition holds one area's weeks.
    ``share``: the shares of :func:`station_share`, which need no other week.
    """
    one = F.lit(1) if weight is None else F.col(weight)
    weekly = df.groupBy(area, week).agg(
        _rows(weight).alias(label),
        *[_mean(m, weight).alias(m) for m in measures],
        *[F.sum(F.when(F.col(station) == v, one)).alias(n) for v, n in stations.items()],
    )
    return encoded_stations(weekly, area, label, stations, encoding)


def encoded_stations(
    weekly: DataFrame, area: str, label: str, stations: Mapping[str, str], encoding: str
) -> DataFrame:
    """Area-weeks whose station columns hold numbers of rows, with these columns encoded.

    For ``count`` all weeks of an area have to be there.
    """
    if encoding == "share":
        return weekly.withColumns({
            n: F.coalesce(F.col(n) / F.col(label), F.lit(0.0)) for n in stations.values()
        })
    all_weeks = Window.partitionBy(area)
    return weekly.withColumns({
        n: F.coalesce(F.sum(n).over(all_weeks).cast("double"), F.lit(0.0))
        for n in stations.values()
    })


def undeclared_stations(
    df: DataFrame, station: str, stations: Mapping[str, str] = STATIONS, count: str = "n_rows",
    weight: str | None = None,
) -> DataFrame:
    """Rows per station that has no column of its own, the missing station included."""
    known = F.coalesce(F.col(station).isin(list(stations)), F.lit(False))
    return df.where(~known).groupBy(station).agg(_rows(weight).alias(count))


def total_by(df: DataFrame, key: str, value: str, total: str | None = None) -> DataFrame:
    """Sum of a value per key."""
    return df.groupBy(key).agg(F.sum(value).alias(total or value))


def cases_per_week(base: DataFrame, week: str, label: str = "resposta") -> DataFrame:
    return total_by(base, week, label).orderBy(week)


def cases_per_area(base: DataFrame, area: str, label: str = "resposta") -> DataFrame:
    return total_by(base, area, label).orderBy(F.col(label).desc(), area)


def value_counts(df: DataFrame, column: str, count: str = "count") -> DataFrame:
    """Non-null values and how often they occur, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(count))
        .orderBy(F.col(count).desc(), column)
    )
