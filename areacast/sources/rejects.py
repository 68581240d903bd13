"""Files whose unusable lines are kept apart with a reason instead of failing the read or turning into nulls.

A file is read as text by its declared columns. Lines that do not have these columns, values that do not parse and values beyond their limits become
reasons of the row. Rows go to one folder with a partition for each verdict, in one pass over the file, as a batch or
as a stream, so that nothing that arrived is lost.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from areacast.fixed import DAY_FIRST_SLASH, REQUEST_BOUNDS
from areacast.functions import decimal_comma, is_reject, parse_date
from areacast.sources.tables import read_folder

CORRUPT, REASONS, VERDICT = "corrupt_line", "reject_reasons", "verdict"
ACCEPTED, REJECTED = "accepted", "rejected"


def read_lines(
    source, path: str, columns: Sequence[str], sep: str = ";", encoding: str = "UTF-8", header: bool = True
) -> DataFrame:
    """The columns of a delimited file as text; a line of more or fewer fields also shows in ``corrupt_line``.

    ``source`` is ``spark.read`` or ``spark.readStream``. The header of each file, if it has one, is skipped; its order is
    that of ``columns``.
    """
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    return (
        source.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def check_lines(
    lines: DataFrame,
    dates: Mapping[str, str] | None = None,
    measures: Sequence[str] = (),
    required: Sequence[str] = (),
    bounds: Mapping[str, tuple[float, float]] = REQUEST_BOUNDS,
    low_high: tuple[str, str] | None = ("temp_minima", "temp_maxima"),
) -> DataFrame:
    """Typed rows with the reasons against them and a verdict; text that does not parse gives null.

    Reasons, in this order: ``line`` for a line of other columns, which is not checked further; the name of a ``required`` column that is missing, of a
    date or measure that does not parse, of a measure beyond its limits; ``low>high``. A missing measure is no reason unless it is
    required: it is filled later. Measures that have no limit are only parsed.
    """
    dates = dates or {}
    typed = {n: parse_date(F.col(n), f) for n, f in dates.items()}
    typed |= {m: decimal_comma(F.col(m)) for m in measures}
    reasons: list[Column] = []
    for name in dict.fromkeys([*required, *typed]):
        broken = F.lit(False)
        if name in required:
            broken = broken | F.col(name).isNull()
        if name in typed:
            broken = broken | is_reject(F.col(name), typed[name])
        if name in measures and name in bounds:
            broken = broken | F.coalesce(~typed[name].between(*bounds[name]), F.lit(False))
        reasons.append(F.when(broken, F.lit(name)))
    if low_high and set(low_high) <= set(measures):
        low, high = low_high
        reasons.append(F.when(typed[low] > typed[high], F.lit(f"{low}>{high}")))
    found = F.when(F.col(CORRUPT).isNotNull(), F.lit("line")).otherwise(F.concat_ws(",", *reasons))
    verdict = F.when(found == "", ACCEPTED).otherwise(REJECTED)
    plain = [c for c in lines.columns if c not in typed]
    return lines.select(
        *plain, *[value.alias(n) for n, value in typed.items()],
        # Text as it came, to mend a rejected row by.
        *[F.when(verdict == REJECTED, F.col(n)).alias(f"raw_{n}") for n in typed],
        found.alias(REASONS), verdict.alias(VERDICT),
    )


def sort_out(checked: DataFrame, path: str, mode: str = "error") -> None:
    """Write all rows to one folder, accepted and rejected ones in partitions of their own."""
    checked.write.mode(mode).partitionBy(VERDICT).parquet(path)


def sort_out_stream(checked: DataFrame, path: str, checkpoint: str, wait: bool = True) -> StreamingQuery:
    """The same for files as they arrive: each row is written exactly once."""
    query = (
        checked.writeStream.format("parquet")
        .partitionBy(VERDICT)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query


def sorted_rows(checked: DataFrame, path: str, verdict: str) -> DataFrame:
    """The written rows of one verdict; reads its partition only."""
    stored = read_folder(checked.sparkSession, path, checked.schema)
    return stored.where(F.col(VERDICT) == verdict).drop(VERDICT)


def reason_counts(rejected: DataFrame) -> DataFrame:
    """How many rejected rows each reason occurs in."""
    each = rejected.select(F.explode(F.split(REASONS, ",")).alias("reason"))
    return each.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def check_weather(lines: DataFrame, measures: Sequence[str], date: str = "data", station: str = "nome_estacao",
                  bounds: Mapping[str, tuple[float, float]] = REQUEST_BOUNDS,
                  low_high: tuple[str, str] | None = ("temp_minima", "temp_maxima")) -> DataFrame:
    """Lines of a weather file: station and date are required, measures may be missing."""
    return check_lines(lines, {date: DAY_FIRST_SLASH}, measures, [station, date], bounds, low_high)
