from datetime import date

import pytest
from pyspark.sql import functions as F

from areacast import functions as fn
from areacast.operators import clean


def values(spark, data, schema, column):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def test_decimal_comma(spark):
    df = spark.createDataFrame([("1,5",), ("12",), (None,), ("x",)], "v string")
    parsed = fn.decimal_comma(F.col("v"))
    assert [r[0] for r in df.select(parsed).collect()] == [1.5, 12.0, None, None]
    assert clean.count_rejects(df, {"v": parsed}).collect() == [("v", 1)]


def test_to_decimal_comma(spark):
    assert values(spark, [(1.5,), (0.0,), (-2.25,)], "v double", fn.to_decimal_comma(F.col("v"))) \
        == ["1,50", "0,00", "-2,25"]


def test_parse_date(spark):
    data = [("03/01/2016",), ("2016-01-03",), ("31/02/2016",), (None,)]
    parsed = fn.parse_date(F.col("v"), "dd/MM/yyyy")
    assert values(spark, data, "v string", parsed) == [date(2016, 1, 3), None, None, None]
    df = spark.createDataFrame(data, "v string")
    assert clean.count_rejects(df, {"v": parsed}).collect() == [("v", 2)]


def test_parse_dates_keeps_typed_dates(spark):
    df = spark.createDataFrame([(date(2016, 1, 3), "03-01-2016")], "a date, b string")
    parsed = clean.parse_dates(df, {"a": "dd-MM-yyyy", "b": "dd-MM-yyyy"})
    assert parsed.collect() == [(date(2016, 1, 3), date(2016, 1, 3))]


def test_date_key(spark):
    assert values(spark, [(date(2016, 1, 3),)], "d date", fn.date_key(F.col("d"))) == [
        "2016/01/03 00:00:00"
    ]


@pytest.mark.parametrize(("key", "expected"), [
    (fn.week_key_calendar, [201653, 201752, 201801, 201709]),
    (fn.week_key_iso, [201553, 201652, 201901, 201709]),
])
def test_week_keys(spark, key, expected):
    days = [(date(2016, 1, 1),), (date(2017, 1, 1),), (date(2018, 12, 31),), (date(2017, 3, 1),)]
    assert values(spark, days, "d date", key(F.col("d"))) == expected
    assert values(spark, days, "d date", key(F.col("d"), as_text=True)) == [
        str(e) for e in expected
    ]


def test_labels(spark):
    data = [("COHAB - RECIFE",), ("A - B - C",), ("NONE",)]
    assert values(spark, data, "l string", fn.label_area(F.col("l"))) == ["COHAB", "A", "NONE"]
    assert values(spark, data, "l string", fn.label_station(F.col("l"))) == [
        "RECIFE", "B - C", None
    ]
    composed = fn.compose_label(F.lit("COHAB"), F.lit("RECIFE"))
    assert values(spark, [(1,)], "x int", composed) == ["COHAB - RECIFE"]


def test_concat_key_is_null_when_a_part_is(spark):
    key = fn.concat_key(F.col("a"), F.col("b"), separator="|")
    assert values(spark, [("x", 1), ("x", None)], "a string, b int", key) == ["x|1", None]


def test_names(spark):
    data = [("cabrobó",), (None,)]
    assert values(spark, data, "n string", fn.name_or_unknown(F.col("n"))) == [
        "CABROBÓ", "SEM_INFORMACAO"
    ]
    assert values(spark, [("Ação É",)], "n string", fn.fold_accents(F.col("n"))) == ["Acao E"]
    df = spark.createDataFrame([("CABROBÓ",), ("RECIFE",), (None,)], "s string")
    assert [r[0] for r in clean.sentinel_fill(clean.alias_values(df, ["s"]), ["s"]).collect()] == [
        "CABROBO", "RECIFE", "SEM_INFORMACAO"
    ]
