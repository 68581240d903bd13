"""Counts of every stage, taken while the one write of a job runs.

A stage is watched by an observation of its own: its rows, and per column the values that a parse could not read. The counts come with the action that
runs the stage; no table is read for them. Each stage has to take part in one action only. Counts are for people:
where a lost executor makes Spark repeat part of a stage, they can be too high.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def _metrics(counts: Mapping[str, Column]) -> list[Column]:
    named = {f"count|{name}": F.count_if(condition) for name, condition in counts.items()}
    return [F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in named.items()]]


class StageAudit:
    """Watches stages by name; the results can be asked for once the jobs have run."""

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, int]] = {}

    def watch(self, name: str, df: DataFrame, counts: Mapping[str, Column] | None = None) -> DataFrame:
        """The rows unchanged. ``counts`` are conditions of which the rows are counted, such as rejects.

        Columns whose names begin with ``_`` are helpers and not counted as columns of the stage.
        """
        if name in self._seen:
            raise ValueError(f"stage watched twice: {name}")
        seen = Observation(f"stage {name}")
        self._seen[name] = seen, len([c for c in df.columns if not c.startswith("_")])
        return df.observe(seen, *_metrics(counts or {}))

    def stages(self, spark: SparkSession) -> DataFrame:
        """Rows and columns of each stage."""
        lines = [(name, seen.get["n_rows"], width) for name, (seen, width) in self._seen.items()]
        return spark.createDataFrame(lines, "stage string, n_rows bigint, n_columns int")

    def counts(self, spark: SparkSession) -> DataFrame:
        """The named counts of each stage."""
        lines = [
            (name, metric.removeprefix("count|"), value)
            for name, (seen, _) in self._seen.items()
            for metric, value in seen.get.items() if metric.startswith("count|")
        ]
        return spark.createDataFrame(lines, "stage string, counted string, n_rows bigint")


def watch_stream(name: str, df: DataFrame, counts: Mapping[str, Column] | None = None) -> DataFrame:
    """The rows of a stream unchanged; a :class:`ProgressAudit` hears what each batch counts."""
    return df.observe(f"stage {name}", *_metrics(counts or {}))


class ProgressAudit(StreamingQueryListener):
    """Adds up what the batches of streams report; register it with ``spark.streams.addListener``."""

    def __init__(self) -> None:
        super().__init__()
        self.totals: dict[str, dict[str, int]] = {}
        self._batches: set[tuple[str, int]] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        # A batch reports again where it is repeated.
        if (str(progress.id), progress.batchId) in self._batches:
            return
        self._batches.add((str(progress.id), progress.batchId))
        for stage, row in progress.observedMetrics.items():
            own = self.totals.setdefault(stage.removeprefix("stage "), {})
            for metric, value in row.asDict().items():
                own[metric] = own.get(metric, 0) + value

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
