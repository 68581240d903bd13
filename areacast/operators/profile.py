"""Profiling: nulls, types, descriptions and correlations.

Wide results of one aggregate are turned into rows by ``inline``, so each profile is a
single pass over the table whatever the number of columns.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from areacast.operators.moments import pair_moments, pearson
from areacast.operators.running import running_totals
from areacast.sources.tables import written


def _as_rows(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    structs = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))


def null_counts(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Number of nulls of every column, one row per column."""
    names = list(names or df.columns)
    one_row = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    return _as_rows(one_row, [{"column_name": F.lit(n), "n_nulls": F.col(n)} for n in names])


def null_inventory(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """The columns that hold a null, with their number."""
    return null_counts(df, names).filter(F.col("n_nulls") > 0)


def assert_no_nulls(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows unchanged; a null in a named column fails the query and names the column."""

    def required(name: str) -> Column:
        text = F.lit(f"null in column {name}")
        return F.coalesce(F.col(name), F.raise_error(text).cast(df.schema[name].dataType))

    return df.withColumns({n: required(n) for n in names})


def column_info(df: DataFrame) -> DataFrame:
    """Non-null count and type of every column."""
    one_row = df.agg(*[F.count(F.col(n)).alias(n) for n in df.columns])
    return _as_rows(one_row, [
        {
            "column_name": F.lit(f.name),
            "n_non_null": F.col(f.name),
            "data_type": F.lit(f.dataType.simpleString()),
        }
        for f in df.schema.fields
    ])


def stage_audit(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each named stage, one row per stage."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
# A sketch of _SKETCH items per level errs by less than one part in _ACCURACY of the ranks in nearly all
# cases; the slice around a quantile reaches _MARGIN times as far to either side.
_SKETCH = 8_192
_ACCURACY = 2_000
_MARGIN = 4
_ALL = [(float("-inf"), float("inf"))]


def _given(name: str) -> Column:
    """The value as a double; NaN counts as missing."""
    return F.nullif(F.col(name).cast("double"), F.lit(float("nan")))


def describe_numeric(
    df: DataFrame,
    names: Sequence[str],
    quantiles: Mapping[str, float] | None = None,
) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quantiles and maximum per column.

    Two scans: moments and rank sketches, then the exact quantiles.
    """
    quantiles = quantiles or QUARTILES
    stats = {
        "n_values": F.count, "mean": F.avg, "std": F.stddev_samp,
        "min_value": F.min, "max_value": F.max,
    }
    found = _sketched(df, names, quantiles, stats)
    exact = _quantiles(df, names, quantiles, found)
    lines = [
        (n, *[found[f"{i}|{label}"] for label in stats], *[exact[n, q] for q in quantiles])
        for i, n in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(
        lines,
        "column_name string, n_values bigint, mean double, std double, min_value double, max_value double, "
        + ", ".join(f"`{q}` double" for q in quantiles),
    )


def exact_quantiles(
    df: DataFrame, names: Sequence[str], quantiles: Mapping[str, float] | None = None
) -> DataFrame:
    """Linearly interpolated quantiles of the given values, one row per column; null without a value.

    A rank sketch narrows each quantile to a thin slice of the values. A second scan counts the values
    before, between and behind the slices, so the ranks in a slice are exact, and only slices are sorted. Where a rank
    turns out to lie outside its slice, all values of that column take its place. The driver sees a
    few numbers per column only.
    """
    quantiles = quantiles or QUARTILES
    found = _sketched(df, names, quantiles, {"n_values": F.count})
    exact = _quantiles(df, names, quantiles, found)
    lines = [(n, *[exact[n, q] for q in quantiles]) for n in names]
    return df.sparkSession.createDataFrame(
        lines, "column_name string, " + ", ".join(f"`{q}` double" for q in quantiles)
    )


def _sketched(df: DataFrame, names: Sequence[str], quantiles: Mapping[str, float], stats: Mapping) -> Row:
    """One scan: the stats of each column, and the ends of the slices around its quantiles."""
    reach = _MARGIN / _ACCURACY
    ends = [
        min(max(end, 0.0), 1.0) for q in quantiles.values() for end in (q - reach, q + reach)
    ]
    named = {f"{i}|{label}": stat(_given(n)) for i, n in enumerate(names) for label, stat in stats.items()}
    sketches = [F.kll_sketch_agg_double(_given(n), F.lit(_SKETCH)) for n in names]
    one_row = df.agg(
        *[stat.alias(name) for name, stat in named.items()],
        *[sketch.alias(f"{i}|sketch") for i, sketch in enumerate(sketches)],
    )
    # An empty sketch has no quantiles.
    return one_row.select(*[F.col(f"`{name}`") for name in named], *[
        F.when(
            F.col(f"`{i}|n_values`") > 0,
            F.kll_sketch_get_quantile_double(F.col(f"`{i}|sketch`"), F.lit(ends)),
        ).alias(f"{i}|ends")
        for i in range(len(names))
    ]).first()


def _quantiles(
    df: DataFrame, names: Sequence[str], quantiles: Mapping[str, float], found: Row
) -> dict[tuple[str, str], float | None]:
    """The exact quantiles, by column and label."""
    counts = {i: found[f"{i}|n_values"] for i in range(len(names))}
    slices = {
        i: _disjoint(list(zip(found[f"{i}|ends"][::2], found[f"{i}|ends"][1::2]))) or _ALL
        for i, n in counts.items() if n
    }
    exact: dict[tuple[str, str], float | None] = {(n, q): None for n in names for q in quantiles}
    while slices:
        ranks = _Ranks(df, names, slices, counts)
        missed = set()
        wanted = []
        for i in slices:
            for label, q in quantiles.items():
                position = (counts[i] - 1) * q
                ends = [ranks.place(i, math.floor(position) + 1), ranks.place(i, math.ceil(position) + 1)]
                if None in ends:
                    missed.add(i)
                wanted += [(i, label, end, *at) for end, at in zip(("low", "high"), ends) if at]
        values = ranks.values(wanted)
        for i in set(slices) - missed:
            for label, q in quantiles.items():
                position = (counts[i] - 1) * q
                low, high = values[i, label, "low"], values[i, label, "high"]
                part = position - math.floor(position)
                exact[names[i], label] = low + (high - low) * part if part else low
        slices = {i: _ALL for i in missed}
    return exact


def _disjoint(slices: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """The slices in order, overlapping ones as one, those inside out left away."""
    merged: list[tuple[float, float]] = []
    for low, high in sorted(s for s in slices if s[0] <= s[1]):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


class _Ranks:
    """The ranks of the values in some slices of the columns, from one scan.

    The slices are the odd regions of a column; what lies before, between and behind them are the even ones, which are only counted,
    while the values of the slices are written with their numbers.
    """

    def __init__(
        self,
        df: DataFrame,
        names: Sequence[str],
        slices: Mapping[int, Sequence[tuple[float, float]]],
        counts: Mapping[int, int],
    ):
        self.spark = df.sparkSession
        values = df.select(*[_given(names[i]).alias(f"v{i}") for i in slices])
        regions, between, inside = {}, {}, F.lit(False)
        for i, own in slices.items():
            value = F.col(f"v{i}")
            regions[i] = F.lit(None).cast("int")
            ends = [float("-inf"), *[e for s in own for e in s], float("inf")]
            for k in range(len(own) + 1):
                after = F.lit(True) if k == 0 else value > ends[2 * k]
                before = F.lit(True) if k == len(own) else value < ends[2 * k + 1]
                between[f"{i}|{2 * k}"] = F.count_if(value.isNotNull() & after & before)
            for k, (low, high) in enumerate(own):
                regions[i] = F.when(value.between(low, high), 2 * k + 1).otherwise(regions[i])
                inside = inside | value.between(low, high)
        seen = Observation()
        pieces = [
            F.struct(F.lit(i).alias("column"), region.alias("region"), F.col(f"v{i}").alias("value"))
            for i, region in regions.items()
        ]
        self.collapsed = written(
            values.observe(seen, *[c.alias(n) for n, c in between.items()])
            .where(inside)
            .select(F.inline(F.filter(F.array(*pieces), lambda p: p["region"].isNotNull())))
            .groupBy("column", "region", "value").agg(F.count(F.lit(1)).alias("n_equal")),
            "slices",
        )
        within = self.collapsed.groupBy("column", "region").agg(F.sum("n_equal").alias("n")).collect()
        sliced = {(r["column"], r["region"]): r["n"] for r in within}
        outside = seen.get
        for i in slices:
            own = [n for key, n in outside.items() if key.startswith(f"{i}|")]
            if sum(own) + sum(n for (column, _), n in sliced.items() if column == i) != counts[i]:
                # A repeated task has counted twice: count again in an aggregate, which cannot.
                outside = values.agg(*[c.alias(n) for n, c in between.items()]).first().asDict()
                break
        self.totals = {
            i: [sliced.get((i, k), 0) if k % 2 else outside[f"{i}|{k}"] for k in range(2 * len(own) + 1)]
            for i, own in slices.items()
        }

    def place(self, column: int, rank: int) -> tuple[int, int] | None:
        """Region of a rank and the rank in it; None where that region's values are not known."""
        for region, total in enumerate(self.totals[column]):
            if rank <= total:
                return (region, rank) if region % 2 else None
            rank -= total
        return None

    def values(self, wanted: Sequence[tuple]) -> dict[tuple[int, str, str], float]:
        """The values at (column, label, end, region, rank)."""
        if not wanted:
            return {}
        asked = self.spark.createDataFrame(
            list(wanted), "column int, label string, end string, region int, rank bigint"
        )
        ranked = running_totals(
            self.collapsed, [F.col("value")], {"n_equal": "last_rank"}, ["column", "region"]
        ).join(asked, ["column", "region"])
        lowest = F.col("last_rank") - F.col("n_equal") + 1
        found = ranked.where(F.col("rank").between(lowest, F.col("last_rank"))).collect()
        return {(r["column"], r["label"], r["end"]): r["value"] for r in found}


def describe_categorical(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, number of distinct values, most frequent value and its frequency per column.

    Of equally frequent values the lowest one is shown.
    """
    counted = (
        df.select(*[F.col(n).cast("string").alias(n) for n in names])
        .unpivot([], list(names), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy("column_name").agg(
        F.sum("n").alias("n_values"),
        F.count(F.lit(1)).alias("n_unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def headline_facts(
    base: DataFrame, area: str, week: str, label: str, population: str, temperatures: Sequence[str]
) -> DataFrame:
    """One row of key figures of an area-week base.

    Weeks and areas are grouped to one row each before they are counted.
    """
    weekly = base.groupBy(week).agg(F.sum(label).alias("_cases"))
    peak = weekly.agg(
        F.struct(
            F.min_by(week, F.struct(-F.col("_cases"), F.col(week))).alias("week"),
            F.max("_cases").alias("cases"),
            F.count(F.lit(1)).alias("weeks"),
        ).alias("peak")
    ).scalar()
    areas = base.select(area).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    facts = base.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(label).alias("max_cases"),
        F.avg(population).alias("mean_population"),
        *[F.avg(t).alias(f"mean_{t}") for t in temperatures],
        *[F.stddev_samp(t).alias(f"std_{t}") for t in temperatures],
    )
    return facts.withColumns({
        "n_weeks": peak.getField("weeks"),
        "n_areas": areas,
        "peak_week": peak.getField("week"),
        "peak_week_cases": peak.getField("cases"),
    })


def _correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each unordered pair of columns, a column with itself included, with its correlation."""
    return pair_moments(df, names).select("feature_1", "feature_2", pearson().alias("correlation"))


def correlation_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, one row per pair.

    Over the rows where both are given, null when one of them is constant there; NaN counts as missing.
    """
    pairs = _correlations(df, names)
    mirrored = F.when(
        F.col("feature_1") != F.col("feature_2"),
        F.array(
            F.struct("feature_1", "feature_2"),
            F.struct(F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2")),
        ),
    ).otherwise(F.array(F.struct("feature_1", "feature_2")))
    return pairs.select(F.inline(mirrored), "correlation")


def correlation_pairs(df: DataFrame, names: Sequence[str], above: float = 0.1) -> DataFrame:
    """Unordered pairs with their absolute correlation: over the limit, below 1, descending."""
    pairs = _correlations(df, names).where("feature_1 <> feature_2")
    strength = F.abs(F.col("correlation"))
    return (
        pairs.withColumn("correlation", strength)
        .filter((F.col("correlation") > above) & (F.round("correlation", 12) != 1.0))
        .orderBy(F.col("correlation").desc(), "feature_1", "feature_2")
    )
