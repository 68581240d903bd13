"""Column names, column sets and the union of tables that differ in both."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areacast.fixed import ACCENTED, UNACCENTED

_FOLD = str.maketrans(ACCENTED, UNACCENTED)
_INTEGRAL = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def normalize_headers(
    df: DataFrame, replacements: Sequence[tuple[str, str]] = (), fold: bool = False
) -> DataFrame:
    """Replace text in all column names, in the given order, in one projection.

    ``fold`` also drops accents, lower-cases and turns blanks and dots into ``_``.
    """

    def rename(name: str) -> str:
        for old, new in replacements:
            name = name.replace(old, new)
        if fold:
            name = name.translate(_FOLD).lower().replace(".", " ")
            name = "_".join(name.split())
        return name

    return df.toDF(*[rename(c) for c in df.columns])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns; names that do not occur are ignored."""
    return df.drop(*names)


def tag(df: DataFrame, **values) -> DataFrame:
    """Add constant columns; text is stored in upper case."""
    return df.withColumns(
        {n: F.lit(v.upper() if isinstance(v, str) else v) for n, v in values.items()}
    )


def conform_columns(df: DataFrame, required: Sequence[str], default=0) -> DataFrame:
    """Add the required columns that are missing, holding a constant.

    Names are compared as the session compares them: without case unless it is set otherwise.
    """
    alike = _name_key(df)
    present = {alike(c) for c in df.columns}
    missing = [c for c in required if alike(c) not in present]
    return df.withColumns({c: F.lit(default) for c in missing}) if missing else df


def _name_key(df: DataFrame) -> Callable[[str], str]:
    """What two names have in common that the session takes for the same column."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return (lambda name: name) if exact else str.lower


def _common_type(name: str, found: list[T.DataType]) -> T.DataType:
    kinds = list(dict.fromkeys(found))
    real = [t for t in kinds if not isinstance(t, T.NullType)]
    if len(real) <= 1:
        return real[0] if real else kinds[0]
    if all(t in _INTEGRAL for t in real):
        return max(real, key=_INTEGRAL.index)
    numbers = (*map(type, _INTEGRAL), T.FloatType, T.DoubleType, T.DecimalType)
    if all(isinstance(t, numbers) for t in real):
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in real):
            return T.DoubleType()
        # Whole numbers have at most 19 digits; the widest of both parts holds every value.
        digits = max(t.precision - t.scale if isinstance(t, T.DecimalType) else 19 for t in real)
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in real)
        return T.DecimalType(min(38, digits + scale), scale) if digits + scale <= 38 else T.DoubleType()
    if all(isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)) for t in real):
        stamps = [t for t in real if not isinstance(t, T.DateType)]
        if len(stamps) == 1:
            return stamps[0]
    shown = ", ".join(t.simpleString() for t in real)
    raise ValueError(f"column {name} has types {shown}; name its type in `types`")


def harmonized_union(
    tables: Sequence[DataFrame], types: Mapping[str, str] | None = None
) -> DataFrame:
    """All rows of all tables under the union of their columns.

    A column missing from a table is null there. A column of differing types takes the
    type named in ``types``, else the wider number or time type; any other conflict is an
    error. Rows are never lost and duplicates stay.

    Names that differ only in case are one column, under its first spelling, unless the session is
    case sensitive; a table that holds two of them is an error.
    """
    alike = _name_key(tables[0])
    types = {alike(name): kind for name, kind in (types or {}).items()}
    found: dict[str, list[T.DataType]] = {}
    spelling: dict[str, str] = {}
    for table in tables:
        own = [alike(c) for c in table.columns]
        twice = sorted({c for c in table.columns if own.count(alike(c)) > 1})
        if twice:
            raise ValueError(f"a table holds one column more than once: {', '.join(twice)}")
        for field in table.schema.fields:
            spelling.setdefault(alike(field.name), field.name)
            found.setdefault(alike(field.name), []).append(field.dataType)
    by_key = {
        key: types[key] if key in types else _common_type(spelling[key], kinds)
        for key, kinds in found.items()
    }
    target = {spelling[key]: kind for key, kind in by_key.items()}
    cast = [
        t.select(*[
            F.col(f"`{c}`").try_cast(by_key[alike(c)]).alias(spelling[alike(c)]) for c in t.columns
        ])
        for t in tables
    ]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)
    return united.select(*[F.col(f"`{c}`") for c in target])
