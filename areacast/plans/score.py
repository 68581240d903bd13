"""Scoring a request of weather and area rows, and publishing the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import ImputerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.fixed import PREDICTED, REQUEST_BOUNDS
from areacast.functions import label_area, label_station, week_key_calendar, week_key_iso
from areacast.operators.aggregate import model_base
from areacast.operators.clean import alias_values, impute_mean, sentinel_fill
from areacast.operators.joins import expand_to_areas
from areacast.operators.learn import imputer_means
from areacast.operators.merge import as_base_rows, merge_predictions
from areacast.operators.partials import base_of_partials, partials
from areacast.plans.spec import BaseSpec
from areacast.sources.requests import accepted, check_requests
from areacast.sources.tables import Place, distinct_values, one_of, place, written

# What fills gaps: the imputer saved with a model, a row of means, numbers, or None for the rows' own means.
Means = ImputerModel | DataFrame | Mapping[str, float] | None
WEEK_KEYS = {"iso": week_key_iso, "calendar": week_key_calendar}


def request_rows(
    weather: DataFrame, areas: DataFrame, spec: BaseSpec = BaseSpec(), week_rule: str = "iso"
) -> DataFrame:
    """Prepared weather, with its week, once per area of the station. Batch or stream."""
    dated = weather.withColumn(spec.week, WEEK_KEYS[week_rule](F.col(spec.obs_date)))
    expanded = expand_to_areas(dated, areas, spec.obs_station, spec.station)
    return expanded.withColumnsRenamed({spec.obs_station: spec.station, spec.dim_area: spec.area})


def form_rows(form: DataFrame, spec: BaseSpec = BaseSpec(), week_rule: str = "iso") -> DataFrame:
    """Submitted forms in the shape of :func:`request_rows`.

    A form names its area, station and weather in one row, so there is nothing to join and
    forms of the same station do not mix.
    """
    label = F.col("bairro_estacao")
    return form.select(
        label_area(label).alias(spec.area),
        label_station(label).alias(spec.station),
        F.col("populacao").cast("double").alias(spec.population),
        WEEK_KEYS[week_rule](F.col("data")).alias(spec.week),
        *[F.col(m) for m in spec.measures],
    )


def clean_request(
    rows: DataFrame,
    spec: BaseSpec = BaseSpec(),
    means: Means = None,
) -> DataFrame:
    """Names and measures as in training; the means are the request's own unless given."""
    named = alias_values(rows, [spec.station], spec.aliases)
    named = sentinel_fill(named, [spec.area, spec.station])
    if isinstance(means, ImputerModel):
        return means.transform(named)
    return impute_mean(named, spec.means, means=means)


def weekly_weather(
    weather: DataFrame, spec: BaseSpec = BaseSpec(), week_rule: str = "iso"
) -> DataFrame:
    """Partials of prepared weather per station and week: all that scoring needs of the days."""
    dated = weather.withColumn(spec.week, WEEK_KEYS[week_rule](F.col(spec.obs_date)))
    return partials(dated, [spec.obs_station, spec.week], spec.measures)


def expanded_weeks(
    weeks: DataFrame, areas: DataFrame, spec: BaseSpec = BaseSpec(), hot_splits: int = 1
) -> DataFrame:
    """:func:`weekly_weather` once per area of the station, with names as in training.

    The join sees a station's weeks, not its days. ``hot_splits`` spreads a station of very many weeks or areas
    over several shuffle partitions, by the week.
    """
    split_by = [spec.week] if hot_splits > 1 else []
    expanded = expand_to_areas(
        weeks, areas, spec.obs_station, spec.station, hot_splits=hot_splits, split_by=split_by
    )
    named = expanded.withColumnsRenamed({spec.obs_station: spec.station, spec.dim_area: spec.area})
    return sentinel_fill(
        alias_values(named, [spec.station], spec.aliases), [spec.area, spec.station]
    )


def weeks_base(
    weeks: DataFrame,
    areas: DataFrame,
    spec: BaseSpec = BaseSpec(),
    means: Means = None,
    hot_splits: int = 1,
) -> DataFrame:
    """The base of weather that is summed by station and week already."""
    if isinstance(means, ImputerModel):
        means = imputer_means(means)
    return base_of_partials(
        expanded_weeks(weeks, areas, spec, hot_splits), spec.area, spec.week, spec.station,
        spec.measures, [spec.population], spec.stations, means, "n_observations",
        spec.station_encoding,
    )


def request_base(
    weather: DataFrame,
    areas: DataFrame,
    spec: BaseSpec = BaseSpec(),
    means: Means = None,
    week_rule: str = "iso",
    hot_splits: int = 1,
) -> DataFrame:
    """The request in the shape of the base, with the number of observations as no label.

    Days are summed per station and week before they are joined with the areas. The means that fill
    gaps are the request's own, over all days and areas, unless given.
    """
    return weeks_base(weekly_weather(weather, spec, week_rule), areas, spec, means, hot_splits)


def _base_of(rows: DataFrame, spec: BaseSpec, means) -> DataFrame:
    """Rows of an area and a day, cleaned and grouped by area and week."""
    return model_base(
        clean_request(rows, spec, means), spec.area, spec.week, spec.station, spec.means,
        "n_observations", spec.stations, encoding=spec.station_encoding,
    )


def predicted(base: DataFrame, model: PipelineModel, spec: BaseSpec = BaseSpec()) -> DataFrame:
    """Predicted cases of a request in the shape of the base, as base rows."""
    return as_base_rows(model.transform(base), spec.base_columns, spec.label, kind=spec.kind)


def score(
    weather: DataFrame,
    areas: DataFrame,
    model: PipelineModel,
    spec: BaseSpec = BaseSpec(),
    means: Means = None,
    week_rule: str = "iso",
    hot_splits: int = 1,
) -> DataFrame:
    """Predicted cases per area and week as base rows."""
    base = request_base(weather, areas, spec, means, week_rule, hot_splits)
    return predicted(base, model, spec)


def score_forms(
    form: DataFrame,
    model: PipelineModel,
    spec: BaseSpec = BaseSpec(),
    means: Means = None,
    week_rule: str = "iso",
    bounds: Mapping[str, tuple[float, float]] = REQUEST_BOUNDS,
) -> DataFrame:
    """Predicted cases of the forms that keep the limits, as base rows."""
    kept = accepted(check_requests(form, bounds))
    return predicted(_base_of(form_rows(kept, spec, week_rule), spec, means), model, spec)


def score_features(
    rows: DataFrame, model: PipelineModel, features: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Score a file that already holds the features, in any column order, without a label."""
    missing = [f for f in features if f not in rows.columns]
    if missing:
        raise ValueError(f"features not in the rows: {', '.join(missing)}")
    typed = rows.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])
    return model.transform(typed).select(*keep, *features, "prediction")


def publish(
    predictions: DataFrame,
    base_path: str | Place,
    spec: BaseSpec = BaseSpec(),
    mode: str = "replace_by_key",
) -> None:
    """Merge predictions into a base, a folder or a catalog table, as :func:`store` writes it.

    Only the weeks that the predictions touch are read and replaced, so the work follows the request and not
    the history. The predictions are scored once, and the new rows are written to the work folder before
    they replace partitions that they come from.
    """
    spark = predictions.sparkSession
    scored = written(stored_rows(predictions, spec), "scored")
    base = place(base_path)
    history = base.read(spark, base_schema(spec))
    # Weeks, not rows: as a list they choose the partitions when the read is planned.
    weeks = distinct_values(scored, spec.week)
    old = history.filter(F.col(spec.kind) == PREDICTED).filter(one_of(spec.week, weeks))
    merged = merge_predictions(
        old, scored, [spec.area, spec.week], mode, spec.week, spec.label, spec.kind
    )
    staged = written(stored_rows(merged, spec), "predictions")
    base.replace_partitions(staged.repartition(spec.week), [spec.kind, spec.week])


def store(base: DataFrame, base_path: str | Place, spec: BaseSpec = BaseSpec()) -> None:
    """Replace a base, a folder or a catalog table, partitioned by kind of row and week, a file per week."""
    rows = stored_rows(base, spec).repartition(spec.week)
    place(base_path).replace(rows, [spec.kind, spec.week])


def stored_rows(base: DataFrame, spec: BaseSpec = BaseSpec()) -> DataFrame:
    """Base rows with the stored types: week as text, label as double."""
    return base.select(*spec.base_columns).withColumns({
        spec.week: F.col(spec.week).cast("string"),
        spec.label: F.col(spec.label).cast("double"),
    })


def base_schema(spec: BaseSpec = BaseSpec()) -> str:
    numbers = ", ".join(f"{c} double" for c in [spec.label, *spec.features])
    return f"{spec.area} string, {spec.week} string, {numbers}, {spec.kind} string"
