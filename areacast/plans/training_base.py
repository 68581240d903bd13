"""From case files, areas and weather to the (area, week) base."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.fixed import AREA_HEADERS, CASE_HEADERS, DAY_FIRST_SLASH, OBSERVED, WEATHER_HEADERS
from areacast.functions import is_reject
from areacast.operators.aggregate import collapse, model_base
from areacast.operators.audit import StageAudit
from areacast.operators.clean import (
    alias_values,
    column_means,
    impute_mean,
    parse_dates,
    parse_measures,
    sentinel_fill,
)
from areacast.operators.joins import enrich_area, enrich_weather
from areacast.operators.schema import harmonized_union, normalize_headers, tag
from areacast.plans.spec import BaseSpec

ROWS = "n_rows"


def prepare_areas(areas: DataFrame, spec: BaseSpec = BaseSpec()) -> DataFrame:
    named = normalize_headers(areas, AREA_HEADERS)
    return named.select(spec.dim_area, F.col(spec.population).cast("double"), spec.station)


def prepare_weather(
    weather: DataFrame, spec: BaseSpec = BaseSpec(), date_format: str = DAY_FIRST_SLASH
) -> DataFrame:
    """Station observations with a date and numbers; only the columns that are joined."""
    lower = _weather_columns(weather)
    dated = parse_dates(lower, {spec.obs_date: date_format})
    parsed = parse_measures(dated, list(spec.measures))
    return parsed.select(spec.obs_station, spec.obs_date, *spec.measures)


def _weather_columns(weather: DataFrame) -> DataFrame:
    named = normalize_headers(weather, WEATHER_HEADERS)
    return named.toDF(*[c.lower() for c in named.columns])


def audited_weather(
    weather: DataFrame, audit: StageAudit, spec: BaseSpec = BaseSpec(), date_format: str = DAY_FIRST_SLASH
) -> DataFrame:
    """:func:`prepare_weather` as the stage ``weather``, with the text that did not parse counted per column."""
    parsed_columns = [spec.obs_date, *spec.measures]
    lower = _weather_columns(weather)
    raw = {c: f"_raw_{c}" for c in parsed_columns}
    kept = lower.withColumns({name: F.col(c) for c, name in raw.items()})
    dated = parse_dates(kept, {spec.obs_date: date_format})
    parsed = parse_measures(dated, list(spec.measures)).select(
        spec.obs_station, *parsed_columns, *raw.values()
    )
    counts = {c: is_reject(F.col(name), F.col(c)) for c, name in raw.items()}
    return audit.watch("weather", parsed, counts).select(spec.obs_station, *parsed_columns)


def prepare_cases(
    cases: DataFrame, source: str, date_format: str, spec: BaseSpec = BaseSpec(), **tags
) -> DataFrame:
    """One case file: common names, the onset as a date, the name of the source."""
    named = normalize_headers(cases, CASE_HEADERS)
    return tag(parse_dates(named, {spec.onset: date_format}), **{spec.source: source}, **tags)


def unified_cases(
    prepared: Mapping[str, DataFrame], types: Mapping[str, str] | None = None
) -> DataFrame:
    """All case files in one table."""
    return harmonized_union(list(prepared.values()), types)


def enriched_cases(
    cases: DataFrame,
    areas: DataFrame,
    weather: DataFrame,
    spec: BaseSpec = BaseSpec(),
    fanout: str = "keep",
    weather_fanout: str = "keep",
) -> DataFrame:
    """Distinct (area, week, onset day) with their number of cases, area and weather.

    Cases are counted before the joins. A hot area, or the missing one, then takes part in
    the joins with one row per day and not with all its cases, and the means over case rows
    follow from the counts. ``fanout`` and ``weather_fanout`` say what several rows of one area, or of one
    station and day, do: multiply the cases, give the first row only, or raise an error.
    """
    counted = collapse(cases, [spec.area, spec.week, spec.onset], ROWS)
    with_area = enrich_area(counted, areas, spec.area, spec.dim_area, fanout)
    return enrich_weather(
        with_area, weather, spec.station, spec.onset, spec.obs_station, spec.obs_date,
        weather_fanout,
    )


def cleaned_cases(
    enriched: DataFrame, spec: BaseSpec = BaseSpec(), means=None, weight: str | None = ROWS
) -> DataFrame:
    """Names with a sentinel, measures with the mean over all case rows."""
    named = alias_values(enriched, [spec.station], spec.aliases)
    named = sentinel_fill(named, [spec.area, spec.station])
    return impute_mean(named, spec.means, means=means, weight=weight)


def training_means(enriched: DataFrame, spec: BaseSpec = BaseSpec()) -> DataFrame:
    """The one row of means that scoring can reuse."""
    return column_means(enriched, spec.means, weight=ROWS)


def training_base(
    cases: DataFrame,
    areas: DataFrame,
    weather: DataFrame,
    spec: BaseSpec = BaseSpec(),
    fanout: str = "keep",
    weather_fanout: str = "keep",
) -> DataFrame:
    """The model base: one lazy plan that reads the cases once."""
    enriched = enriched_cases(cases, areas, weather, spec, fanout, weather_fanout)
    return base_of(cleaned_cases(enriched, spec), spec)


def base_of(cleaned: DataFrame, spec: BaseSpec = BaseSpec()) -> DataFrame:
    base = model_base(
        cleaned, spec.area, spec.week, spec.station, spec.means, spec.label, spec.stations, ROWS,
        spec.station_encoding,
    )
    return base.withColumn(spec.kind, F.lit(OBSERVED)).select(*spec.base_columns)
