"""Left joins of facts to dimensions, and the audit of keys that multiply rows.

No join here carries a broadcast hint. Spark broadcasts a dimension when its own
size estimate, or the size AQE measures at run time, is under the session's
threshold; beyond it the join becomes a shuffled one, where AQE splits skewed
partitions and ``hot_splits`` spreads keys that are known to be hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_rows(
    dim: DataFrame, keys: Sequence[str], fanout: str, prefer: Sequence[str] = ()
) -> DataFrame:
    """The dimension with at most one row per key.

    ``first`` keeps the lowest row by ``prefer`` and then the other columns; ``error``
    makes the query fail on a repeated key and names it.
    """
    rest = [*prefer, *[c for c in dim.columns if c not in keys and c not in prefer]]
    grouped = dim.groupBy(*keys).agg(
        F.min(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_rows")
    )
    if fanout == "error":
        shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        text = F.concat(F.lit("more than one dimension row for key: "), shown)
        grouped = grouped.filter(
            F.when(F.col("_rows") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
        )
    return grouped.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])


def lookup_left(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    fanout: str = "keep",
    prefer: Sequence[str] = (),
    hot_splits: int = 1,
    split_by: Sequence[str] = (),
) -> DataFrame:
    """All facts with the matching dimension columns; ``on`` maps fact to dimension keys.

    Several dimension rows per key multiply the facts (``fanout="keep"``), are reduced
    to one (``"first"``) or fail the query (``"error"``).
    ``hot_splits`` > 1 spreads each key over that many shuffle partitions by a hash of
    ``split_by``, at the price of that many copies of the dimension.
    """
    if fanout not in ("keep", "first", "error"):
        raise ValueError(f"unknown fanout: {fanout}")
    dim_keys = list(on.values())
    twice = sorted(set(facts.columns) & (set(dim.columns) - set(dim_keys)))
    if twice:
        raise ValueError(f"columns on both sides: {', '.join(twice)}")
    if fanout != "keep":
        dim = unique_rows(dim, dim_keys, fanout, prefer)
    marked = {key: f"_key_{i}" for i, key in enumerate(dim_keys)}
    dim = dim.withColumnsRenamed(marked)
    match = [F.col(fact) == F.col(marked[key]) for fact, key in on.items()]
    if hot_splits > 1:
        if not split_by:
            raise ValueError("hot_splits needs split_by: columns that differ within a hot key")
        facts = facts.withColumn("_split", F.pmod(F.xxhash64(*split_by), F.lit(hot_splits)))
        splits = F.sequence(F.lit(0), F.lit(hot_splits - 1)).cast("array<bigint>")
        dim = dim.withColumn("_dim_split", F.explode(splits))
        match.append(F.col("_split") == F.col("_dim_split"))
    joined = facts.join(dim, match, "left")
    return joined.drop(*marked.values(), "_split", "_dim_split")


def enrich_area(
    cases: DataFrame,
    areas: DataFrame,
    area: str = "no_bairro_residencia",
    dim_area: str = "bairro",
    fanout: str = "keep",
    **hot,
) -> DataFrame:
    """Cases with the population and station of their area."""
    return lookup_left(cases, areas, {area: dim_area}, fanout=fanout, **hot)


def enrich_weather(
    cases: DataFrame,
    weather: DataFrame,
    station: str = "estacao",
    day: str = "dt_diagnostico_sintoma",
    dim_station: str = "nome_estacao",
    dim_day: str = "data",
    fanout: str = "keep",
    **hot,
) -> DataFrame:
    """Cases with the measures of their station on their day; both days are dates."""
    return lookup_left(
        cases, weather, {station: dim_station, day: dim_day}, fanout=fanout, **hot
    )


def expand_to_areas(
    weather: DataFrame,
    areas: DataFrame,
    station: str = "estacao",
    dim_station: str = "estacao",
    **hot,
) -> DataFrame:
    """Each station row once per area of that station; stations without areas stay."""
    return lookup_left(weather, areas, {station: dim_station}, **hot)


def fanout_audit(dim: DataFrame, keys: Sequence[str], rows: str = "n_rows") -> DataFrame:
    """The keys that occur more than once, and how often: the factor a join multiplies by."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows)).filter(F.col(rows) > 1)
