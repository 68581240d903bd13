"""Cleaning: typed values, sentinels, aliases and mean imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areacast.fixed import ALIASES, UNKNOWN
from areacast.functions import decimal_comma, is_reject, name_or_unknown, parse_date


def parse_dates(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Turn the named columns into dates: text by its format, times by a cast."""
    return df.withColumns({
        name: parse_date(F.col(name), fmt)
        if isinstance(df.schema[name].dataType, T.StringType)
        else F.col(name).cast("date")
        for name, fmt in formats.items()
    })


def parse_measures(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Turn decimal-comma text into doubles; numbers are cast."""
    return df.withColumns({
        name: decimal_comma(F.col(name))
        if isinstance(df.schema[name].dataType, T.StringType)
        else F.col(name).cast("double")
        for name in names
    })


def count_rejects(raw: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """Per column, how many given values the parse turned into null; one row each."""
    counts = raw.agg(*[
        F.count_if(is_reject(F.col(name), value)).alias(name) for name, value in parsed.items()
    ])
    pairs = [F.struct(F.lit(n).alias("column_name"), F.col(n).alias("n_rejects")) for n in parsed]
    return counts.select(F.inline(F.array(*pairs)))


def alias_values(
    df: DataFrame, names: Sequence[str], aliases: Mapping[str, str] = ALIASES
) -> DataFrame:
    """Replace whole values by their alias in the named columns."""
    return df.replace(dict(aliases), subset=list(names))


def sentinel_fill(df: DataFrame, names: Sequence[str], unknown: str = UNKNOWN) -> DataFrame:
    """Upper-case the named columns; missing names become the sentinel."""
    return df.withColumns({n: name_or_unknown(F.col(n), unknown) for n in names})


def given(name: str) -> Column:
    """The value as a double; NaN counts as missing."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def mean_columns(means: DataFrame | Mapping[str, float], names: Sequence[str]) -> dict[str, Column]:
    """The mean of each named column as a column that raises an error where there is none.

    A row of means becomes one scalar subquery holding all of them.
    """
    if isinstance(means, Mapping):
        mean_of = {n: F.lit(float(means[n])) for n in names}
    else:
        packed = means.select(F.struct(*[F.col(n) for n in names]).alias("means")).scalar()
        mean_of = {n: packed.getField(n) for n in names}
    return {
        n: F.coalesce(
            mean_of[n],
            F.raise_error(F.lit(f"column {n} has no value to take a mean of")).cast("double"),
        )
        for n in names
    }


def column_means(df: DataFrame, names: Sequence[str], weight: str | None = None) -> DataFrame:
    """One row with the mean of the given values of each column; NaN counts as missing.

    With ``weight`` each row counts as that many rows, so rows that were collapsed
    to counts give the mean over the rows they stand for.
    """

    def mean(name: str) -> Column:
        value = given(name)
        if weight is None:
            return F.avg(value)
        weighed = F.when(value.isNotNull(), F.col(weight))
        return F.sum(value * F.col(weight)) / F.sum(weighed)

    return df.agg(*[mean(n).alias(n) for n in names])


def impute_mean(
    df: DataFrame,
    names: Sequence[str],
    means: DataFrame | Mapping[str, float] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Fill nulls and NaN with the column mean.

    The means come from the rows themselves, or from ``means``: the one row of a saved
    :func:`column_means`, or plain numbers. They reach the rows as one scalar subquery
    holding all of them, so filling is a plain projection: no join, no window.
    A column with no value at all raises an error that names it.
    """
    fill = mean_columns(column_means(df, names, weight) if means is None else means, names)
    return df.withColumns({n: F.coalesce(given(n), fill[n]) for n in names})
