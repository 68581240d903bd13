import random

import pytest
from pyspark.sql import functions as F

from areacast.operators import aggregate, clean, joins
from tests.conftest import rows


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("A", 1, "x"), ("A", 2, "y"), ("B", 3, "z")], "bairro string, populacao int, estacao string"
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the facts has one key, another third has none."""
    keys = ["A"] * 100 + [None] * 100 + ["B"] * 50 + ["C"] * 50
    return spark.createDataFrame(
        list(enumerate(keys)), "id int, no_bairro_residencia string"
    ).repartition(8)


def brute_left(facts, dim):
    out = []
    for i, key in facts:
        matches = [(p, s) for k, p, s in dim if k == key] or [(None, None)]
        out += [(i, key, p, s) for p, s in matches]
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("splits", [1, 4])
def test_lookup_matches_brute_force(spark, skewed, dim, splits, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if broadcast else "-1")
    try:
        joined = joins.enrich_area(skewed, dim, hot_splits=splits, split_by=["id"])
        found = sorted((tuple(r) for r in joined.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == brute_left(
        [tuple(r) for r in skewed.collect()], [tuple(r) for r in dim.collect()]
    )
    assert joined.columns == ["id", "no_bairro_residencia", "populacao", "estacao"]


def test_fanout(spark, skewed, dim):
    first = joins.enrich_area(skewed, dim, fanout="first")
    assert first.count() == skewed.count()
    assert {r.populacao for r in first.filter("no_bairro_residencia = 'A'").collect()} == {1}
    prefer = joins.enrich_area(
        skewed, dim.withColumn("o", -F.col("populacao")), fanout="first", prefer=["o"]
    )
    assert {r.populacao for r in prefer.filter("no_bairro_residencia = 'A'").collect()} == {2}
    with pytest.raises(Exception, match="key: A"):
        joins.enrich_area(skewed, dim, fanout="error").collect()
    unique = dim.filter("estacao <> 'y'")
    assert joins.enrich_area(skewed, unique, fanout="error").count() == skewed.count()
    with pytest.raises(ValueError, match="fanout"):
        joins.enrich_area(skewed, dim, fanout="last")
    with pytest.raises(ValueError, match="split_by"):
        joins.enrich_area(skewed, dim, hot_splits=2)
    with pytest.raises(ValueError, match="both sides: populacao"):
        joins.enrich_area(skewed.withColumn("populacao", F.lit(1)), dim)


def test_fanout_audit(dim):
    assert rows(joins.fanout_audit(dim, ["bairro"])) == [("A", 2)]


def test_stations_without_areas_stay(spark, dim):
    weather = spark.createDataFrame([("x", 1), ("none", 2)], "estacao string, t int")
    assert rows(joins.expand_to_areas(weather, dim)) == [
        ("none", 2, None, None), ("x", 1, "A", 1)
    ]


def test_impute_weighted_equals_row_by_row(spark):
    rng = random.Random(1)
    data = [(rng.choice("abc"), rng.choice([None, 1.0, 2.5, 7.0])) for _ in range(300)]
    df = spark.createDataFrame(data, "k string, v double")
    expected = [v for _, v in data if v is not None]
    mean = sum(expected) / len(expected)
    counted = aggregate.collapse(df, ["k", "v"], "n")
    by_rows = clean.impute_mean(df, ["v"]).groupBy("k").agg(F.avg("v").alias("v"))
    by_counts = aggregate.area_week_base(
        clean.impute_mean(counted, ["v"], weight="n").withColumn("w", F.lit(1)),
        "k", "w", ["v"], "n_cases", weight="n",
    )
    assert clean.column_means(df, ["v"]).first()[0] == pytest.approx(mean)
    one, other = dict(by_rows.collect()), {r.k: r.v for r in by_counts.collect()}
    assert one == pytest.approx(other)
    assert sum(r.n_cases for r in by_counts.collect()) == 300


def test_impute_with_given_means(spark):
    df = spark.createDataFrame([(None,), (4.0,)], "v double")
    assert rows(clean.impute_mean(df, ["v"], means={"v": 2.0})) == [(2.0,), (4.0,)]
    saved = spark.createDataFrame([(3.0,)], "v double")
    assert rows(clean.impute_mean(df, ["v"], means=saved)) == [(3.0,), (4.0,)]


def test_column_without_values_is_named(spark):
    df = spark.createDataFrame([(None,)], "v double")
    with pytest.raises(Exception, match="column v has no value"):
        clean.impute_mean(df, ["v"]).collect()


def test_null_station_gets_the_sentinel_column(spark):
    df = spark.createDataFrame([("A", None), ("A", "RECIFE")], "area string, estacao string")
    named = clean.sentinel_fill(df, ["estacao"])
    pivot = aggregate.station_pivot(
        aggregate.area_station_count(named, "area", "estacao"), "area", "estacao"
    )
    assert "null" not in pivot.columns
    row = pivot.first()
    assert (row.estacao_seminfo, row.estacao_recife, row.estacao_surubim) == (1, 1, None)


def test_model_base_matches_the_separate_operators(spark):
    rng = random.Random(2)
    data = [
        (rng.choice(["hot", "hot", "a", "b"]), rng.choice([1, 2]), rng.choice("xyz"),
         rng.random(), rng.randint(1, 5))
        for _ in range(400)
    ]
    df = spark.createDataFrame(data, "area string, week int, st string, m double, n int")
    stations = {"x": "st_x", "y": "st_y", "absent": "st_absent"}
    for weight in (None, "n"):
        one_pass = aggregate.model_base(
            df, "area", "week", "st", ["m"], "cases", stations, weight
        )
        counts = aggregate.area_station_count(df, "area", "st", "qtd", weight)
        base = aggregate.area_week_base(df, "area", "week", ["m"], "cases", weight)
        apart = aggregate.attach_station_counts(
            base, aggregate.station_pivot(counts, "area", "st", "qtd", stations), "area",
            list(stations.values()),
        )
        key = {(r.area, r.week): r.asDict() for r in apart.collect()}
        for r in one_pass.collect():
            assert r.asDict() == pytest.approx(key[r.area, r.week])
