"""Scoring of files as they arrive.

Means and model are fixed artefacts of training: a stream has no mean of its own. A prediction is one of an
area and week: :func:`publish_arrivals` keeps sums per station and week and scores the weeks that a batch
changes anew, so a week that arrives in parts ends as if it had come at once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.feature import ImputerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from areacast.operators.partials import ROWS, given_of, sum_of
from areacast.plans.score import (
    clean_request,
    predicted,
    publish,
    request_rows,
    weekly_weather,
    weeks_base,
)
from areacast.plans.spec import BaseSpec
from areacast.sources.rejects import ACCEPTED, REJECTED, VERDICT
from areacast.sources.tables import Place, overwrite_partitions, written
from areacast.streaming import state


def arrival_rows(
    weather: DataFrame,
    areas: DataFrame,
    means: ImputerModel | Mapping[str, float],
    spec: BaseSpec = BaseSpec(),
    week_rule: str = "iso",
) -> DataFrame:
    """Prepared weather of a stream -> feature rows per area; ``areas`` is a static table."""
    cleaned = clean_request(request_rows(weather, areas, spec, week_rule), spec, means)
    return cleaned.withColumns({
        name: (F.col(spec.station) == value).cast("double")
        for value, name in spec.stations.items()
    })


def preview_scores(
    weather: DataFrame,
    areas: DataFrame,
    model: PipelineModel,
    means: ImputerModel | Mapping[str, float],
    spec: BaseSpec = BaseSpec(),
    week_rule: str = "iso",
) -> DataFrame:
    """A first look at arriving days: each day and area as if its week consisted of this day.

    Not what is published: a prediction is one of an area and week, see :func:`publish_arrivals`.
    """
    return model.transform(arrival_rows(weather, areas, means, spec, week_rule)).drop("features")


def _state_schema(spec: BaseSpec) -> str:
    sums = ", ".join(f"`{sum_of(m)}` double, `{given_of(m)}` bigint" for m in spec.measures)
    return f"`{spec.obs_station}` string, `{ROWS}` bigint, {sums}, `{spec.week}` int"


def apply_batch(
    weather: DataFrame,
    number: int,
    areas: DataFrame,
    model: PipelineModel,
    means: ImputerModel | Mapping[str, float],
    state_path: str,
    base_path: str | Place,
    spec: BaseSpec = BaseSpec(),
    week_rule: str = "iso",
) -> None:
    """Add prepared weather to the state, score the weeks that this changes, and publish them into the base.

    With stations as shares these are the weeks that the batch touches. As counts over the whole period they
    depend on all weeks, so all are scored again, from their partials. A batch that runs
    twice leaves what it leaves once.
    """
    keys = [spec.obs_station, spec.week]
    arrived = weekly_weather(weather, spec, week_rule)
    weeks = state.advance(arrived, state_path, keys, spec.week, spec.measures, number)
    if not weeks:
        return
    changed = state.latest(
        weather.sparkSession, state_path, _state_schema(spec), spec.week,
        None if spec.station_encoding == "count" else weeks, before=number + 1,
    )
    publish(predicted(weeks_base(changed, areas, spec, means), model, spec), base_path, spec)


def publish_arrivals(
    weather: DataFrame,
    areas: DataFrame,
    model: PipelineModel,
    means: ImputerModel | Mapping[str, float],
    state_path: str,
    base_path: str | Place,
    checkpoint: str,
    spec: BaseSpec = BaseSpec(),
    week_rule: str = "iso",
    wait: bool = True,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Score what has arrived since the last run per area and week, and publish it into the base.

    ``weather`` is a stream of prepared weather. Rows are summed by station and week as they arrive and never
    read again: each batch reads the partials of the weeks it touches (:mod:`areacast.streaming.state`).
    With ``rejects_path`` the stream is one of checked lines (:func:`rejects.check_weather`): rejected ones go to that folder,
    a partition per batch, accepted ones are scored.
    """

    def each(batch: DataFrame, number: int) -> None:
        if rejects_path is not None:
            checked = written(batch, "checked")
            rejected = checked.where(F.col(VERDICT) == REJECTED).drop(VERDICT)
            overwrite_partitions(rejected.withColumn("batch", F.lit(number)), rejects_path, ["batch"])
            batch = checked.where(F.col(VERDICT) == ACCEPTED).select(
                spec.obs_station, spec.obs_date, *spec.measures
            )
        apply_batch(batch, number, areas, model, means, state_path, base_path, spec, week_rule)

    query = (
        weather.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query


def to_folder(stream: DataFrame, path: str, checkpoint: str, wait: bool = True) -> StreamingQuery:
    """Process what has arrived since the last run into a parquet folder, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query
