"""Delimited text files.

No read infers a schema: either the whole schema is declared, or the file is read
as text by its header and the wanted columns are typed afterwards (for wide files
of which a few columns matter; Spark then parses those columns only).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_delimited(
    source,
    path: str,
    schema: StructType | str,
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Read by declared schema. ``source`` is ``spark.read`` or ``spark.readStream``.

    The header of each file is checked against the schema, so swapped columns fail
    instead of landing under the wrong name. An empty field is null.
    """
    return (
        source.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_by_header(
    spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8"
) -> DataFrame:
    """Read all columns as text, named by the header line."""
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
        .option("inferSchema", False)
        .csv(path)
    )


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Keep the named columns and cast them; a value that does not fit gives null."""
    missing = [name for name in types if name not in df.columns]
    if missing:
        raise ValueError(f"columns not in the file: {', '.join(missing)}")
    return df.select(*[F.col(f"`{n}`").try_cast(t).alias(n) for n, t in types.items()])


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", mode: str = "error", encoding: str = "UTF-8"
) -> None:
    """Write a folder of delimited parts, each with a header."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("encoding", encoding)
        .csv(path)
    )
