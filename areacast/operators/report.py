"""Reports over base rows: actual against predicted, campaign ranking, cases by source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from areacast.fixed import OBSERVED, PREDICTED
from areacast.operators.running import running_totals


def actual_vs_predicted(
    base: DataFrame,
    area: str = "no_bairro_residencia",
    week: str = "ds_semana_notificacao",
    label: str = "resposta",
    kind: str = "ds_tipo_base",
) -> DataFrame:
    """Actual and predicted cases per area and week of the year, with their difference."""
    week_number = (F.col(week).cast("int") % 100).alias("week_number")
    value = F.col(label).cast("double")
    report = base.groupBy(area, week_number).agg(
        F.sum(F.when(F.col(kind) == OBSERVED, value)).alias("actual"),
        F.sum(F.when(F.col(kind) == PREDICTED, value)).alias("predicted"),
    )
    delta = F.col("predicted") - F.col("actual")
    return report.withColumns({
        "delta": delta,
        "delta_pct": F.when(F.col("actual") != 0, delta / F.col("actual") * 100),
    })


def campaign_ranking(
    base: DataFrame,
    first_week: int,
    last_week: int,
    top: int | None = None,
    area: str = "no_bairro_residencia",
    week: str = "ds_semana_notificacao",
    label: str = "resposta",
    kind: str = "ds_tipo_base",
) -> DataFrame:
    """Areas by predicted cases over a span of weeks: rank and cumulative share.

    With ``top`` the ranking ends there: Spark keeps that many rows per task and the
    windows run over them alone. Without it all areas are ranked by distributed running
    totals. Shares always refer to all areas. Equal totals are ranked by name.
    """
    in_span = F.col(week).cast("int").between(first_week, last_week)
    totals = (
        base.filter((F.col(kind) == PREDICTED) & in_span)
        .groupBy(area)
        .agg(F.sum(F.col(label).cast("double")).alias("predicted"))
    )
    order = [F.col("predicted").desc(), F.col(area).asc()]
    if top is None:
        counted = totals.withColumn("_one", F.lit(1).cast("bigint"))
        ranked = running_totals(counted, order, {"_one": "rank", "predicted": "cumulative"})
    else:
        kept = totals.orderBy(*order).limit(top)
        so_far = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = kept.withColumns({
            "rank": F.row_number().over(so_far).cast("bigint"),
            "cumulative": F.sum("predicted").over(so_far),
        })
    total = totals.agg(F.sum("predicted").alias("total")).scalar()
    return ranked.select(
        area,
        "predicted",
        "rank",
        F.when(total != 0, F.col("cumulative") / total).alias("cumulative_share"),
    )


def cases_by_source(cases: DataFrame, keys: Sequence[str], label: str = "resposta") -> DataFrame:
    """Number of cases per source and the other given keys."""
    return cases.groupBy(*keys).agg(F.count(F.lit(1)).alias(label))
