"""Tables by catalog name or by path, and results written to the work folder."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from areacast.session import hadoop_folder, scratch_path

# Whether a statement's shuffle files are deleted when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def create_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    path: str | None = None,
) -> None:
    """Create the table from the rows; leave an existing one alone.

    Later inserts replace only the partitions that they bring, see :func:`overwrite_table_partitions`. With ``bucket_by`` the rows are
    stored in so many buckets, sorted by these columns: tables of the same buckets are joined on them without a shuffle.
    """
    writer = df.write.mode("ignore").partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def overwrite_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Replace the table by the rows, which are computed before the old ones go and may come from them."""
    spark = df.sparkSession
    rows = written(df, "table")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if path is not None:
        # The files of a table that was placed by its path stay when it is dropped.
        system, folder = hadoop_folder(spark, path)
        system.delete(folder, True)
    create_table(rows, name, partition_by, path=path)


def overwrite_table_partitions(df: DataFrame, name: str) -> None:
    """Replace only the partitions of the table that occur in the rows; columns go by name.

    The table has to be made by :func:`create_table`: it remembers how it is to be overwritten.
    """
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name, overwrite=True)


@dataclass(frozen=True)
class Folder:
    """A table kept as a parquet folder."""

    path: str

    def read(self, spark: SparkSession, schema: StructType | str) -> DataFrame:
        return read_folder(spark, self.path, schema)

    def replace(self, df: DataFrame, partition_by: Sequence[str]) -> None:
        overwrite_folder(df, self.path, partition_by)

    def replace_partitions(self, df: DataFrame, partition_by: Sequence[str]) -> None:
        overwrite_partitions(df, self.path, partition_by)


@dataclass(frozen=True)
class CatalogTable:
    """A table of the session's catalog; ``path`` places its files when it is created."""

    name: str
    path: str | None = None

    def read(self, spark: SparkSession, schema: StructType | str) -> DataFrame:
        return read_table(spark, self.name)

    def replace(self, df: DataFrame, partition_by: Sequence[str]) -> None:
        overwrite_table(df, self.name, partition_by, self.path)

    def replace_partitions(self, df: DataFrame, partition_by: Sequence[str]) -> None:
        create_table(df.limit(0), self.name, partition_by, path=self.path)
        overwrite_table_partitions(df, self.name)


Place = Folder | CatalogTable


def place(where: str | Place) -> Place:
    """A path stands for a folder."""
    return Folder(where) if isinstance(where, str) else where


def read_folder(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read a parquet folder by declared schema; partition folders give their column."""
    return spark.read.schema(schema).parquet(path)


def overwrite_folder(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a parquet folder as a whole."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, folder = hadoop_folder(spark, path)
    return system.exists(folder)


def drop_partition(spark: SparkSession, path: str, partition: Sequence[tuple[str, object]]) -> None:
    """Delete one partition of a parquet folder, given as (column, value) pairs."""
    # Fixed value -- the folder name of a null partition.
    null = "__HIVE_DEFAULT_PARTITION__"
    parts = [f"{name}={null if value is None else value}" for name, value in partition]
    system, folder = hadoop_folder(spark, "/".join([path.rstrip("/"), *parts]))
    system.delete(folder, True)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in the rows; the others stay as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def distinct_values(df: DataFrame, key: str) -> list:
    """The values of a key that partitions a table, on the driver; null among them. For weeks and the like only."""
    return [row[0] for row in df.select(key).distinct().collect()]


def one_of(key: str, values: Sequence) -> Column:
    """Whether the key is one of the listed values, null included; on a partition column it prunes the read."""
    listed = F.col(key).isin([v for v in values if v is not None])
    return listed | F.col(key).isNull() if None in values else listed


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the work folder and read back.

    Cuts the lineage where rows are read several times or where a table has to be
    replaced by rows that come from it. A lost executor then costs a re-read only. The shuffle
    files of the write go with it, as nothing reads them again; else they stay until the
    driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete the files of tables made by :func:`written` that nothing reads any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            system, path = hadoop_folder(df.sparkSession, folder)
            system.delete(path, True)


def preview(df: DataFrame, order_by: Sequence[str], n: int, last: bool = False) -> DataFrame:
    """The first (or last) n rows by the given order, as Spark's distributed top-n."""
    keys = [F.col(c).desc() if last else F.col(c).asc() for c in order_by]
    return df.orderBy(*keys).limit(n)


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types; needs no job."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
