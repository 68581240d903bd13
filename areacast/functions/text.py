"""Text expressions: numbers with a decimal comma, names, labels and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from areacast.fixed import ACCENTED, LABEL_SEPARATOR, UNACCENTED, UNKNOWN


def decimal_comma(value: Column) -> Column:
    """``'1,5'`` -> 1.5; text that is no finite number gives null (see :func:`is_reject`)."""
    number = F.replace(value, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def to_decimal_comma(value: Column, digits: int = 2) -> Column:
    """Number -> text with a decimal comma and a fixed number of decimals."""
    return F.replace(value.cast(f"decimal(38,{digits})").cast("string"), F.lit("."), F.lit(","))


def is_reject(raw: Column, parsed: Column) -> Column:
    """True where a value was given but could not be parsed."""
    return raw.isNotNull() & parsed.isNull()


def name_or_unknown(name: Column, unknown: str = UNKNOWN) -> Column:
    """Upper-case name with a sentinel for the missing one."""
    return F.upper(F.coalesce(name, F.lit(unknown)))


def fold_accents(value: Column) -> Column:
    return F.translate(value, ACCENTED, UNACCENTED)


def concat_key(*parts: Column, separator: str = "") -> Column:
    """Parts joined as text; null when any part is null, as an SQL ``concat`` key is."""
    texts = [part.cast("string") for part in parts]
    if not separator:
        return F.concat(*texts)
    spaced = [texts[0]]
    for text in texts[1:]:
        spaced += [F.lit(separator), text]
    return F.concat(*spaced)


def compose_label(area: Column, station: Column, separator: str = LABEL_SEPARATOR) -> Column:
    return F.concat(area, F.lit(separator), station)


def label_area(label: Column, separator: str = LABEL_SEPARATOR) -> Column:
    """The part before the first separator."""
    return F.substring_index(label, separator, 1)


def label_station(label: Column, separator: str = LABEL_SEPARATOR) -> Column:
    """The part after the first separator; null when there is none."""
    at = F.instr(label, separator)
    return F.when(at > 0, F.substr(label, at + len(separator)))
