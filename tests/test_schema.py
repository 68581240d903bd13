from datetime import date

import pytest
from pyspark.sql import functions as F

from areacast.fixed import AREA_HEADERS, WEATHER_HEADERS
from areacast.operators import schema
from tests.conftest import rows


def test_normalize_headers(spark):
    weather = spark.createDataFrame(
        [], "`Código da estação` int, `Temp. Comp. Média` int, `Precipitação` int"
    )
    assert schema.normalize_headers(weather, WEATHER_HEADERS).columns == [
        "codigo_estacao", "temp_comp_media", "Precipitacao"
    ]
    area = spark.createDataFrame([], "`Bairro` int, `População` int, `Estação` int")
    assert schema.normalize_headers(area, AREA_HEADERS).columns == [
        "bairro", "populacao", "estacao"
    ]
    assert schema.normalize_headers(weather, fold=True).columns == [
        "codigo_da_estacao", "temp_comp_media", "precipitacao"
    ]


def test_drop_columns_drops_both_sides_of_a_repeated_name(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    twice = df.join(df.withColumnRenamed("b", "c"), F.lit(True))
    assert schema.drop_columns(twice, ["a", "missing"]).columns == ["b", "c"]


def test_conform_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert schema.conform_columns(df, ["a", "b", "c"]).collect() == [(1, 0, 0)]
    assert schema.conform_columns(df, ["a"]).columns == ["a"]


def test_union_of_differing_columns(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([(2, date(2016, 1, 3))], "a int, c date")
    united = schema.harmonized_union([left, right])
    assert united.columns == ["a", "b", "c"]
    assert rows(united) == [(1, "x", None), (2, None, date(2016, 1, 3))]


def test_union_keeps_values_when_only_one_side_is_required(spark):
    left = spark.createDataFrame([(1,)], "a int NOT NULL")
    right = spark.createDataFrame([(2,)], "a int")
    assert rows(schema.harmonized_union([left, right])) == [(1,), (2,)]


def test_union_widens_numbers_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,)], "v int")
    b = spark.createDataFrame([(2**40,)], "v bigint")
    c = spark.createDataFrame([(0.5,)], "v double")
    assert dict(schema.harmonized_union([a, b]).dtypes) == {"v": "bigint"}
    assert rows(schema.harmonized_union([a, b, c])) == [(0.5,), (1.0,), (1.0,), (float(2**40),)]


def test_union_of_text_and_date_needs_a_rule(spark):
    a = spark.createDataFrame([("2016-01-03",), ("bad",)], "d string")
    b = spark.createDataFrame([(date(2016, 1, 4),)], "d date")
    with pytest.raises(ValueError, match="column d"):
        schema.harmonized_union([a, b])
    united = schema.harmonized_union([a, b], {"d": "date"})
    assert rows(united) == [(None,), (date(2016, 1, 3),), (date(2016, 1, 4),)]


def test_tag(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert schema.tag(df, source="dengue", zika=0).collect() == [(1, "DENGUE", 0)]


def test_union_matches_names_without_case(spark):
    one = spark.createDataFrame([(1, "x")], "Tp int, a string")
    two = spark.createDataFrame([(2.5, "y")], "tp double, A string")
    united = schema.harmonized_union([one, two])
    assert united.columns == ["Tp", "a"]
    assert rows(united) == [(1.0, "x"), (2.5, "y")]
    assert schema.conform_columns(one, ["TP", "b"]).columns == ["Tp", "a", "b"]
    twice = spark.createDataFrame([(1, 2)], "x int, y int").toDF("n", "N")
    with pytest.raises(ValueError, match="more than once"):
        schema.harmonized_union([twice])


def test_union_of_decimals_with_other_numbers(spark):
    one = spark.sql("SELECT CAST(1.25 AS decimal(5,2)) AS n")
    assert rows(schema.harmonized_union([one, spark.sql("SELECT 2.5D AS n")])) == [(1.25,), (2.5,)]
    whole = schema.harmonized_union([one, spark.sql("SELECT 9223372036854775807L AS n")])
    assert whole.dtypes == [("n", "decimal(21,2)")]
    assert [str(r.n) for r in whole.orderBy("n").collect()] == ["1.25", "9223372036854775807.00"]
