import time
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from areacast import session
from areacast.operators.schema import normalize_headers
from areacast.sources import delimited, requests, tables
from areacast.fixed import AREA_HEADERS
from tests.conftest import rows


def test_roundtrip_with_quotes_and_separators(spark, tmp_path):
    data = [("a;b", 'say "x"', None), ("c", "d", "ç")]
    df = spark.createDataFrame(data, "a string, b string, c string")
    path = str(tmp_path / "csv")
    delimited.write_delimited(df, path, sep=";")
    read = delimited.read_delimited(spark.read, path, df.schema, sep=";")
    assert rows(read) == rows(df)


def test_latin1_file_by_header(spark, tmp_path):
    path = tmp_path / "cases.csv"
    path.write_bytes("bairro;notificação;x\nÁGUA FRIA;7;1\nB;oops;2\n".encode("latin-1"))
    read = delimited.read_by_header(spark, str(path), ";", "ISO-8859-1")
    typed = delimited.typed(read, {"bairro": "string", "notificação": "int"})
    assert rows(typed) == [("B", None), ("ÁGUA FRIA", 7)]
    with pytest.raises(ValueError, match="missing"):
        delimited.typed(read, {"missing": "int"})


def test_unnamed_first_column_is_dropped(spark, tmp_path):
    path = tmp_path / "request.csv"
    path.write_text('"";"Bairro";"População";"Estação"\n"1";"COHAB";1000;"RECIFE"\n')
    read = normalize_headers(delimited.read_by_header(spark, str(path)), AREA_HEADERS)
    assert read.columns[0] == "_c0"
    types = {"bairro": "string", "populacao": "int", "estacao": "string"}
    assert rows(delimited.typed(read, types)) == [("COHAB", 1000, "RECIFE")]


def test_swapped_header_fails(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("b;a\n1;2\n")
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_delimited(spark.read, str(path), "a int, b int").collect()


def test_catalog_tables(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, k string")
    tables.create_table(df, "catalog_base", ["k"])
    tables.create_table(df.filter("a = 1"), "catalog_base", ["k"])
    assert rows(tables.read_table(spark, "catalog_base")) == [(1, "x"), (2, "y")]
    tables.overwrite_table(df.filter("a = 1"), "catalog_base", ["k"])
    assert rows(tables.read_table(spark, "catalog_base")) == [(1, "x")]
    spark.sql("DROP TABLE catalog_base")


def test_overwrite_of_one_partition_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "base")
    df = spark.createDataFrame([(1, "original"), (2, "previsto")], "v int, kind string")
    tables.overwrite_folder(df, path, ["kind"])
    new = spark.createDataFrame([(3, "previsto")], "v int, kind string")
    tables.overwrite_partitions(new, path, ["kind"])
    assert rows(tables.read_folder(spark, path, df.schema)) == [(1, "original"), (3, "previsto")]
    tables.overwrite_folder(new, path, ["kind"])
    assert rows(tables.read_folder(spark, path, df.schema)) == [(3, "previsto")]


def test_written_goes_to_the_shared_folder(spark):
    df = tables.written(spark.range(5).toDF("v"), "numbers")
    root = session.work_root(spark).removeprefix("file:")
    assert df.inputFiles()[0].removeprefix("file://").startswith(root)
    assert df.count() == 5


def test_work_folder_of_a_cluster_must_be_named(monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_root(Session())


def test_preview_and_types(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    assert [r.k for r in tables.preview(df, ["k"], 2).collect()] == [1, 2]
    assert [r.k for r in tables.preview(df, ["k"], 1, last=True).collect()] == [3]
    assert tables.column_types(df) == [("k", "int"), ("v", "string")]


@pytest.fixture
def form(spark):
    return spark.createDataFrame(
        [("COHAB - RECIFE", 1000, date(2017, 3, 1), 1.0, 38.0, 18.0, 28.0),
         ("COHAB - RECIFE", 1000, date(2017, 3, 1), 1.0, 18.0, 38.0, 28.0),
         ("AFLITOS - RECIFE", 0, date(2017, 3, 1), 0.0, 51.0, 1.0, None)],
        requests.FORM,
    )


def test_request_rows(form):
    assert requests.area_rows(form).first() == ("COHAB", 1000, "RECIFE")
    assert requests.weather_rows(form).first() == (
        "0", "RECIFE", "01/03/2017", "1,00", "38,00", "18,00", "28,00"
    )


def test_request_limits(form):
    checked = requests.check_requests(form)
    assert [r.reject_reasons for r in checked.collect()] == [
        "", "temp_minima>temp_maxima", "populacao,precipitacao,temp_maxima,temp_comp_media"
    ]
    assert requests.accepted(checked).count() == 1
    assert requests.rejected(checked).count() == 2


def test_request_file_equals_form(spark, form, tmp_path):
    path = str(tmp_path / "weather")
    delimited.write_delimited(requests.weather_rows(form), path, sep=";")
    read = delimited.read_delimited(spark.read, path, requests.WEATHER_REQUEST)
    assert rows(read) == rows(requests.weather_rows(form))
    assert read.select(F.max("data")).first()[0] == "01/03/2017"


def test_written_leaves_no_shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def shuffles():
        return {p for folder in folders for p in Path(folder.getPath()).rglob("shuffle_*")}

    before = shuffles()
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    found = tables.written(counts, "counts")
    # The files are deleted in the background.
    until = time.monotonic() + 20
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffles() - before
    assert {(r["k"], r["n"]) for r in found.collect()} == {(k, 143 if k < 6 else 142) for k in range(7)}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
