"""Score requests: from form values, and the check of their limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.fixed import DAY_FIRST_SLASH, REQUEST_BOUNDS
from areacast.functions import label_area, label_station, to_decimal_comma

# Fixed values -- columns of request files and of the form.
AREA_REQUEST = "bairro string, populacao int, estacao string"
WEATHER_REQUEST = (
    "codigo_estacao string, nome_estacao string, data string, precipitacao string, "
    "temp_maxima string, temp_minima string, temp_comp_media string"
)
WEATHER_COLUMNS = tuple(c.split()[0] for c in WEATHER_REQUEST.split(", "))
FORM = (
    "bairro_estacao string, populacao int, data date, precipitacao double, "
    "temp_maxima double, temp_minima double, temp_comp_media double"
)
MEASURES = ("precipitacao", "temp_maxima", "temp_minima", "temp_comp_media")


def area_rows(form: DataFrame, label: str = "bairro_estacao") -> DataFrame:
    """Form rows -> the rows of an area file."""
    return form.select(
        label_area(F.col(label)).alias("bairro"),
        F.col("populacao").cast("int").alias("populacao"),
        label_station(F.col(label)).alias("estacao"),
    )


def weather_rows(
    form: DataFrame,
    label: str = "bairro_estacao",
    measures: Sequence[str] = MEASURES,
    digits: int = 2,
) -> DataFrame:
    """Form rows -> the rows of a weather file: date and measures as they are in files."""
    return form.select(
        F.lit("0").alias("codigo_estacao"),
        label_station(F.col(label)).alias("nome_estacao"),
        F.date_format("data", DAY_FIRST_SLASH).alias("data"),
        *[to_decimal_comma(F.col(m), digits).alias(m) for m in measures],
    )


def check_requests(
    requests: DataFrame,
    bounds: Mapping[str, tuple[float, float]] = REQUEST_BOUNDS,
    low_high: tuple[str, str] | None = ("temp_minima", "temp_maxima"),
    reasons: str = "reject_reasons",
) -> DataFrame:
    """All rows, with the names of the limits they break; empty text means accepted.

    A missing value breaks its limit.
    """
    checks = [
        F.when(F.col(name).between(low, high), None).otherwise(F.lit(name))
        for name, (low, high) in bounds.items()
    ]
    if low_high:
        low, high = low_high
        checks.append(F.when(F.col(low) > F.col(high), F.lit(f"{low}>{high}")))
    return requests.withColumn(reasons, F.concat_ws(",", *checks))


def accepted(checked: DataFrame, reasons: str = "reject_reasons") -> DataFrame:
    return checked.filter(F.col(reasons) == "").drop(reasons)


def rejected(checked: DataFrame, reasons: str = "reject_reasons") -> DataFrame:
    return checked.filter(F.col(reasons) != "")
