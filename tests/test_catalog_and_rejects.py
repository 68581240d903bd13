"""Catalog tables, buckets, files with unusable lines, and the audit of stages."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from areacast.operators import audit, joins
from areacast.sources import rejects, requests, tables
from tests.conftest import rows

MEASURES = ["precipitacao", "temp_maxima", "temp_minima", "temp_comp_media"]


@pytest.fixture
def table_name(spark, tmp_path):
    name = f"t{abs(hash(str(tmp_path)))}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_only_partitions_of_the_rows_are_replaced(spark, tmp_path, table_name):
    where = tables.CatalogTable(table_name, str(tmp_path / "t"))
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], "v int, w string, k string")
    where.replace(df, ["k"])
    # By name, not by place.
    where.replace_partitions(spark.createDataFrame([("y", "d", 9)], "k string, w string, v int"), ["k"])
    assert rows(where.read(spark, df.schema)) == [(1, "a", "x"), (2, "b", "x"), (9, "d", "y")]
    where.replace_partitions(spark.createDataFrame([("z", "e", 7)], "k string, w string, v int"), ["k"])
    assert where.read(spark, df.schema).count() == 4
    assert len(list((tmp_path / "t").glob("k=*"))) == 3
    where.replace(df.where("v = 1"), ["k"])
    assert rows(tables.read_table(spark, table_name)) == [(1, "a", "x")]


def test_partitions_of_a_table_that_is_not_there_make_it(spark, tmp_path, table_name):
    where = tables.CatalogTable(table_name, str(tmp_path / "t"))
    where.replace_partitions(spark.createDataFrame([(1, "x")], "v int, k string"), ["k"])
    assert rows(where.read(spark, "")) == [(1, "x")]


def test_folder_and_path_are_the_same_place(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "v int, k string")
    where = tables.place(str(tmp_path / "f"))
    assert where == tables.Folder(str(tmp_path / "f")) == tables.place(where)
    where.replace(df, ["k"])
    where.replace_partitions(spark.createDataFrame([(5, "y")], "v int, k string"), ["k"])
    assert rows(where.read(spark, df.schema)) == [(1, "x"), (5, "y")]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    days = [date(2020, 1, 1 + i % 9) for i in range(300)]
    cases = spark.createDataFrame([(i, "AB"[i % 2], d) for i, d in enumerate(days)], "id int, station string, day date")
    weather = spark.createDataFrame([("A", d, 1.0) for d in sorted(set(days))], "of string, at date, t double")
    names = {}
    for name, df, keys in (("cases", cases, ["station", "day"]), ("weather", weather, ["of", "at"])):
        names[name] = f"bucketed_{name}"
        tables.create_table(df, names[name], bucket_by=keys, buckets=4, path=str(tmp_path / name))
    stored = {k: tables.read_table(spark, n).hint("merge") for k, n in names.items()}
    joined = joins.enrich_weather(stored["cases"], stored["weather"], "station", "day", "of", "at")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 300 and joined.where("t is not null").count() == 150
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


LINES = [
    "0;RECIFE;03/01/2016;0,5;31,0;24,0;27,0",      # fine
    "0;RECIFE;04/01/2016;;31,0;;27,0",              # gaps are filled later
    "0;RECIFE;31/02/2016;0,5;31,0;24,0;27,0",       # no such day
    ";;;;;;",                                       # neither station nor day
    "0;RECIFE;03/01/2016;n/d;99,0;24,0;27,0",       # no number; too hot
    "0;RECIFE;03/01/2016;0,5;18,0;38,0;27,0",       # low above high
    "0;RECIFE;03/01/2016;0,5;31,0;24,0;27,0;more",  # a field too many
    "0;RECIFE;03/01/2016",                          # fields missing
    '0;"ÁGUA;FRIA";03/01/2016;0,5;31,0;24,0;27,0',  # a quoted separator is fine
]
EXPECTED = {
    "": 3, "data": 2, "nome_estacao": 1, "precipitacao": 1, "temp_maxima": 1,
    "temp_minima>temp_maxima": 1, "line": 2,
}


@pytest.fixture(params=["UTF-8", "ISO-8859-1"])
def files(request, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    header = ";".join(requests.WEATHER_COLUMNS)
    for i, part in enumerate((LINES[:4], LINES[4:])):
        (folder / f"{i}.csv").write_bytes("\n".join([header, *part, ""]).encode(request.param))
    return str(folder), request.param


def by_reason(spark, checked, out):
    kept = rejects.sorted_rows(checked, out, rejects.ACCEPTED)
    counts = rejects.reason_counts(rejects.sorted_rows(checked, out, rejects.REJECTED))
    return {"": kept.count(), **{r["reason"]: r["n_rows"] for r in counts.collect()}}


def test_lines_of_a_file_are_sorted_out(spark, files, tmp_path):
    path, encoding = files
    out = str(tmp_path / "out")
    checked = rejects.check_weather(rejects.read_lines(spark.read, path, requests.WEATHER_COLUMNS, encoding=encoding), MEASURES)
    rejects.sort_out(checked, out)
    assert by_reason(spark, checked, out) == EXPECTED
    kept = rejects.sorted_rows(checked, out, rejects.ACCEPTED)
    assert {r.nome_estacao for r in kept.collect()} == {"RECIFE", "ÁGUA;FRIA"}
    assert rows(kept.select("data", "temp_minima").where("data = '2016-01-04'")) == [(date(2016, 1, 4), None)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(verdict" in plan
    # The text of a rejected value is there to be mended.
    gone = rejects.sorted_rows(checked, out, rejects.REJECTED)
    assert [r.raw_precipitacao for r in gone.where("reject_reasons like 'precipitacao%'").collect()] == ["n/d"]
    assert gone.where("reject_reasons = 'line'").where("corrupt_line is not null").count() == 2


def test_lines_of_arriving_files_are_sorted_out_once(spark, files, tmp_path):
    path, encoding = files
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):
        lines = rejects.read_lines(spark.readStream, path, requests.WEATHER_COLUMNS, encoding=encoding)
        checked = rejects.check_weather(lines, MEASURES)
        rejects.sort_out_stream(checked, out, progress)
        assert by_reason(spark, checked, out) == EXPECTED


def test_stages_are_counted_by_the_write(spark, tmp_path):
    seen = audit.StageAudit()
    path = str(tmp_path / "in")
    spark.range(100).withColumn("v", F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).otherwise("x")).write.parquet(path)
    raw = seen.watch("read", spark.read.parquet(path))
    parsed = raw.withColumn("_raw", F.col("v")).withColumn("v", F.col("v").try_cast("int"))
    parsed = seen.watch("parsed", parsed, {"v": F.col("v").isNull() & F.col("_raw").isNotNull()})
    grouped = seen.watch("grouped", parsed.groupBy((F.col("id") % 7).alias("k")).count())
    grouped.write.parquet(str(tmp_path / "out"))
    assert rows(seen.stages(spark)) == [("grouped", 7, 2), ("parsed", 100, 2), ("read", 100, 2)]
    assert rows(seen.counts(spark)) == [("parsed", "v", 10)]
    with pytest.raises(ValueError, match="twice"):
        seen.watch("read", raw)


def test_batches_of_a_stream_are_counted(spark, tmp_path):
    path, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    listener = audit.ProgressAudit()
    spark.streams.addListener(listener)
    try:
        for n in (30, 20):
            spark.range(n).write.mode("append").parquet(path)
            stream = audit.watch_stream("ids", spark.readStream.schema("id bigint").parquet(path), {"odd": F.col("id") % 2 == 1})
            query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
                "checkpointLocation", progress).trigger(availableNow=True).start()
            query.awaitTermination()
        for _ in range(100):
            if listener.totals.get("ids", {}).get("n_rows") == 50:
                break
            spark.range(10).count()
        assert listener.totals == {"ids": {"n_rows": 50, "count|odd": 25}}
    finally:
        spark.streams.removeListener(listener)
