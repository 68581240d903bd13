"""Predictions next to history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.fixed import PREDICTED


def as_base_rows(
    scored: DataFrame,
    columns: Sequence[str],
    label: str = "resposta",
    prediction: str = "prediction",
    kind: str = "ds_tipo_base",
) -> DataFrame:
    """Scored rows in the shape of the base: the prediction takes the place of the label."""
    rows = scored.withColumns({
        label: F.col(prediction).cast("double"),
        kind: F.lit(PREDICTED),
    })
    return rows.select(*columns)


def merge_predictions(
    history: DataFrame,
    predictions: DataFrame,
    keys: Sequence[str],
    mode: str = "replace_by_key",
    week: str = "ds_semana_notificacao",
    label: str = "resposta",
    kind: str = "ds_tipo_base",
) -> DataFrame:
    """History and predictions in one table of base rows.

    Columns are matched by name; the week becomes text and the label a double on both
    sides. ``union_distinct`` drops identical rows only; ``replace_by_key`` drops earlier
    predictions for a key that is predicted again.
    """

    def aligned(df: DataFrame) -> DataFrame:
        return df.select(*history.columns).withColumns({
            week: F.col(week).cast("string"),
            label: F.col(label).cast("double"),
        })

    old, new = aligned(history), aligned(predictions)
    if mode == "union_distinct":
        return old.unionByName(new).distinct()
    if mode != "replace_by_key":
        raise ValueError(f"unknown mode: {mode}")
    new = new.distinct()
    again = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    match = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    earlier = old.filter(F.col(kind) == PREDICTED).join(again, match, "left_anti")
    kept = old.filter(~(F.col(kind).eqNullSafe(F.lit(PREDICTED))))
    return kept.unionByName(earlier).unionByName(new)
