import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from areacast.functions import decimal_comma
from areacast.operators import aggregate, clean, profile
from areacast.operators.running import running_totals
from tests.conftest import rows


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({
        # a third of one column is the same value
        "a": np.where(rng.random(900) < 0.34, 5.0, rng.integers(0, 40, 900).astype(float)),
        "b": rng.normal(size=900),
    })
    frame["c"] = frame["a"] * 2 + rng.normal(size=900)
    frame.loc[::7, "b"] = np.nan
    return frame


@pytest.fixture(scope="module")
def df(spark, numbers):
    plain = numbers.astype(object).where(numbers.notna(), None)
    return spark.createDataFrame(
        list(plain.itertuples(index=False, name=None)), "a double, b double, c double"
    ).repartition(8)


def test_describe_numeric(df, numbers):
    expected = numbers.describe()
    for r in profile.describe_numeric(df, ["a", "b", "c"]).collect():
        column = expected[r.column_name]
        assert (r.n_values, r["mean"], r["std"]) == pytest.approx(
            (column["count"], column["mean"], column["std"])
        )
        assert (r.min_value, r.q25, r.q50, r.q75, r.max_value) == pytest.approx(
            (column["min"], column["25%"], column["50%"], column["75%"], column["max"])
        )


@pytest.mark.parametrize("margin", [10, 0, -2000])
def test_quantiles_hold_when_the_slices_miss(df, numbers, monkeypatch, margin):
    """With slices that are too narrow or inside out all values take their place."""
    monkeypatch.setattr(profile, "_MARGIN", margin)
    quantiles = {"low": 0.0, "odd": 0.123, "mid": 0.5, "top": 1.0}
    for r in profile.exact_quantiles(df, ["a", "b"], quantiles).collect():
        for label, q in quantiles.items():
            assert r[label] == pytest.approx(numbers[r.column_name].quantile(q))


def test_quantiles_of_many_values(spark):
    rng = np.random.default_rng(8)
    values = np.where(rng.random(60_000) < 0.33, 1.0, rng.lognormal(size=60_000))
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(16)
    quantiles = {"q01": 0.01, "q25": 0.25, "q50": 0.5, "q99": 0.99}
    found = profile.exact_quantiles(df, ["v"], quantiles).first()
    for label, q in quantiles.items():
        assert found[label] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_describe_of_one_and_of_no_value(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "x double, y double")
    found = {r.column_name: r.asDict() for r in profile.describe_numeric(df, ["x", "y"]).collect()}
    assert (found["x"]["q25"], found["x"]["q75"], found["x"]["n_values"]) == (1.0, 1.0, 1)
    assert (found["y"]["q50"], found["y"]["n_values"]) == (None, 0)


def test_correlations(df, numbers):
    expected = numbers.dropna().corr()
    matrix = profile.correlation_matrix(df.dropna(), ["a", "b", "c"]).collect()
    assert len(matrix) == 9
    for r in matrix:
        assert r.correlation == pytest.approx(expected.loc[r.feature_1, r.feature_2])
    pairs = profile.correlation_pairs(df.dropna(), ["a", "b", "c"], above=0.5).collect()
    assert [(r.feature_1, r.feature_2) for r in pairs] == [("a", "c")]


def test_constant_column_is_no_pair(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "x double, k double")
    assert profile.correlation_pairs(df, ["x", "k"]).collect() == []


def test_describe_categorical(spark):
    df = spark.createDataFrame(
        [("b", "x"), ("a", "x"), ("b", None), ("a", "y"), (None, "y"), ("c", "x")],
        "k string, v string",
    )
    assert rows(profile.describe_categorical(df, ["k", "v"])) == [
        ("k", 5, 3, "a", 2), ("v", 5, 2, "x", 3)
    ]


def test_nulls_and_types(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(profile.null_inventory(df)) == [("b", 1)]
    assert rows(profile.null_counts(df)) == [("a", 0), ("b", 1)]
    assert rows(profile.column_info(df)) == [("a", 2, "int"), ("b", 1, "string")]
    assert profile.assert_no_nulls(df, ["a"]).count() == 2
    with pytest.raises(Exception, match="null in column b"):
        profile.assert_no_nulls(df, ["a", "b"]).collect()


def test_stage_audit(spark):
    a = spark.createDataFrame([(1,), (2,)], "a int")
    assert rows(profile.stage_audit({"one": a, "two": a.union(a).withColumn("b", F.lit(1))})) == [
        ("one", 2, 1), ("two", 4, 2)
    ]


def test_value_counts_orders_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert [tuple(r) for r in aggregate.value_counts(df, "v").collect()] == [
        ("c", 2), ("a", 1), ("b", 1)
    ]


def test_headline_facts(spark):
    base = spark.createDataFrame(
        [("A", 1, 5, 10.0, 30.0), ("B", 1, 2, 20.0, 31.0), ("A", 2, 7, 10.0, 32.0)],
        "area string, week int, cases int, pop double, t double",
    )
    facts = profile.headline_facts(base, "area", "week", "cases", "pop", ["t"]).first()
    assert (facts.n_rows, facts.n_weeks, facts.n_areas) == (3, 2, 2)
    assert (facts.peak_week, facts.peak_week_cases, facts.max_cases) == (1, 7, 7)
    assert (facts.mean_t, facts.std_t) == pytest.approx((31.0, 1.0))


@pytest.mark.parametrize("grouped", [True, False])
def test_running_totals_match_brute_force(spark, grouped):
    rng = random.Random(4)
    # one group and one value hold most of the rows
    data = [
        ("hot" if rng.random() < 0.7 else rng.choice("ab"),
         7 if rng.random() < 0.5 else rng.randint(0, 50), i, rng.randint(1, 9))
        for i in range(2000)
    ]
    df = spark.createDataFrame(data, "g string, k int, id int, v bigint").repartition(8)
    summed = running_totals(
        df, [F.col("k").desc(), F.col("id")], {"v": "total"}, ["g"] if grouped else []
    )
    expected, sums = {}, {}
    for g, _, i, v in sorted(data, key=lambda r: (-r[1], r[2])):
        group = g if grouped else ""
        sums[group] = sums.get(group, 0) + v
        expected[i] = sums[group]
    assert {r.id: r.total for r in summed.collect()} == expected


def test_nan_is_missing_everywhere(spark):
    data = [(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (float("nan"), 9.0), (4.0, float("nan"))]
    df = spark.createDataFrame(data, "a double, b double")
    (pair,) = profile.correlation_pairs(df, ["a", "b"]).collect()
    assert 0.99 < pair.correlation < 1
    none = spark.createDataFrame([(float("nan"), 1.0), (float("nan"), 2.0)], "a double, b double")
    assert profile.correlation_pairs(none, ["a", "b"]).collect() == []
    assert clean.column_means(df, ["a", "b"]).first() == (2.5, 5.25)
    assert clean.impute_mean(df, ["a"]).filter("a = 2.5").count() == 1
    text = spark.createDataFrame([("NaN",), ("Infinity",), ("1,5",)], "t string")
    parsed = text.select("t", decimal_comma(F.col("t")).alias("n"))
    assert [r.n for r in parsed.collect()] == [None, None, 1.5]
    assert clean.count_rejects(text, {"t": decimal_comma(F.col("t"))}).first()["n_rejects"] == 2
