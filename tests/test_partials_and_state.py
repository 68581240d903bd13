"""Sums below the join and kept between batches, against imputing and grouping row by row."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from areacast.operators import learn, partials
from areacast.operators.aggregate import model_base
from areacast.plans import score
from areacast.plans.spec import BaseSpec
from areacast.sources import tables
from areacast.streaming import arrivals, state

SPECS = {kind: BaseSpec(station_encoding=kind) for kind in ("share", "count")}
SPEC = SPECS["share"]
WEATHER = "nome_estacao string, data date, temp_maxima double, temp_minima double, temp_comp_media double"
MEANS = {"populacao": 20.0, "temp_maxima": 31.0, "temp_minima": 20.0, "temp_comp_media": 25.0}


def weather_rows(n, seed=1):
    """A third of the rows at one station; missing values, stations, days and NaN among them."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        station = draw.choice(["RECIFE", "RECIFE", "CABROBÓ", "SURUBIM", "NOWHERE", None])
        day = draw.choice([None] + [date(2017, 1, 1) + timedelta(days=draw.randrange(40))] * 30)
        values = [draw.choice([None, float("nan"), draw.randint(0, 160) / 4]) for _ in range(3)]
        rows.append((station, day, *values))
    return rows


@pytest.fixture(scope="module")
def areas(spark):
    rows = [("A", 10.0, "RECIFE"), ("B", None, "RECIFE"), ("A", 10.0, "CABROBÓ"), ("A", 14.0, "CABROBÓ"),
            (None, 5.0, "SURUBIM"), ("C", float("nan"), "SURUBIM"), ("D", 9.0, "FAR")]
    return spark.createDataFrame(rows, "bairro string, populacao double, estacao string")


@pytest.fixture(scope="module")
def model(spark):
    base = spark.createDataFrame(
        [(f"A{i}", "201601", float(i % 7), 10.0 * i, 30.0 + i % 4, 20.0, 25.0,
          *[float(i % 2)] * 8, "original") for i in range(60)],
        score.base_schema(SPEC),
    )
    rows = learn.training_rows(base, SPEC.features, SPEC.label)
    return learn.fit(rows, SPEC.features, learn.boosting(SPEC.label, maxIter=2, maxDepth=2))


def by_key(df, spec, near=lambda numbers: numbers):
    columns = ["n_observations", *spec.features]
    return {(r[spec.area], r[spec.week]): near([r[c] for c in columns]) for r in df.collect()}


@pytest.mark.parametrize("encoding", list(SPECS))
@pytest.mark.parametrize("means", [None, MEANS])
def test_summed_weeks_equal_rows(spark, areas, encoding, means):
    spec = SPECS[encoding]
    weather = spark.createDataFrame(weather_rows(400), WEATHER).repartition(4)
    cleaned = score.clean_request(score.request_rows(weather, areas, spec), spec, means)
    expected = model_base(
        cleaned, spec.area, spec.week, spec.station, spec.means, "n_observations", spec.stations,
        encoding=encoding,
    )
    found = by_key(score.request_base(weather, areas, spec, means), spec)
    expected = by_key(expected, spec, pytest.approx)
    assert found == expected and len(found) > 20
    assert by_key(score.request_base(weather, areas, spec, means, hot_splits=3), spec) == expected


def test_days_are_summed_below_the_join(spark, areas):
    weather = spark.createDataFrame(weather_rows(50), WEATHER)
    plan = score.weeks_base(score.weekly_weather(weather, SPEC), areas, SPEC, MEANS)
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    operators = [line.lstrip(" :+-").split()[0] for line in lines]
    assert operators.index("Join") < len(operators) - 1 - operators[::-1].index("Aggregate")
    assert operators.count("Aggregate") == 2


def test_a_measure_without_any_value_is_named(spark, areas):
    weather = spark.createDataFrame([("RECIFE", date(2017, 1, 2), None, 1.0, 2.0)], WEATHER)
    with pytest.raises(Exception, match="temp_maxima has no value"):
        score.request_base(weather, areas, SPEC).collect()
    kept = score.request_base(weather, areas, SPEC, MEANS).collect()
    assert {r.temp_maxima for r in kept} == {31.0}


def test_partials_merge_in_any_order(spark):
    rows = [("a", 1, 1.0), ("a", 1, None), ("a", 2, 4.0), ("b", 1, float("nan")), ("a", 1, 3.0)]
    df = spark.createDataFrame(rows, "k string, w int, v double")
    whole = partials.partials(df, ["k", "w"], ["v"])
    first, second = (partials.partials(df.where(f"coalesce(v, 0) {op} 2"), ["k", "w"], ["v"]) for op in ("<", ">="))
    both = partials.merged(second.unionByName(first), ["k", "w"], ["v"])
    assert sorted(whole.collect()) == sorted(both.collect())
    assert ("a", 1, 3, 4.0, 2) in [tuple(r) for r in whole.collect()]
    assert partials.means_of(whole, ["v"], ["w"]).first() == (1.2, 8 / 3)


@pytest.mark.parametrize("encoding", list(SPECS))
def test_batches_leave_what_one_request_leaves(spark, areas, model, tmp_path, encoding):
    spec = SPECS[encoding]
    base_path, state_path = str(tmp_path / "base"), str(tmp_path / "state")
    score.store(spark.createDataFrame([], score.base_schema(spec)), base_path, spec)
    rows = weather_rows(240, seed=5)
    cuts = [rows[i : i + 80] for i in (0, 80, 160)]

    def stored():
        found = tables.read_folder(spark, base_path, score.base_schema(spec)).collect()
        return {(r[spec.area], r[spec.week]): pytest.approx([r[c] for c in [spec.label, *spec.features]])
                for r in found}

    for number, cut in enumerate(cuts):
        weather = spark.createDataFrame(cut, WEATHER)
        for _ in range(2 if number else 1):
            arrivals.apply_batch(weather, number, areas, model, MEANS, state_path, base_path, spec)
        so_far = spark.createDataFrame([r for c in cuts[: number + 1] for r in c], WEATHER)
        expected = score.stored_rows(score.score(so_far, areas, model, spec, MEANS), spec)
        assert stored() == {
            (r[spec.area], r[spec.week]): [r[c] for c in [spec.label, *spec.features]]
            for r in expected.collect()
        }
    arrivals.apply_batch(
        spark.createDataFrame([], WEATHER), 3, areas, model, MEANS, state_path, base_path, spec
    )
    weeks = [p for p in (tmp_path / "state").iterdir() if p.is_dir()]
    assert len(weeks) > 5 and all(1 <= len(list(w.glob("generation=*"))) <= 2 for w in weeks)


def test_only_touched_weeks_are_read(spark, tmp_path):
    path = str(tmp_path / "state")
    df = spark.createDataFrame([("a", w, float(w)) for w in (1, 2, 3)] + [("a", None, 9.0)], "k string, w int, v double")
    schema = "k string, n_rows bigint, sum_v double, given_v bigint, w int"
    parts = partials.partials(df, ["k", "w"], ["v"])
    assert set(state.advance(parts, path, ["k", "w"], "w", ["v"], 0)) == {1, 2, 3, None}
    assert state.advance(parts.where("w = 2"), path, ["k", "w"], "w", ["v"], 1) == [2]
    found = state.latest(spark, path, schema, "w", [2, None])
    assert sorted(tuple(r) for r in found.collect()) == sorted([("a", 2, 4.0, 2, 2), ("a", 1, 9.0, 1, None)], key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [((") >= 1 and "w#" in plan.split("PartitionFilters:")[1].split("]")[0]
    before = state.latest(spark, path, schema, "w", [2], before=1)
    assert [tuple(r) for r in before.collect()] == [("a", 1, 2.0, 1, 2)]
    assert state.latest(spark, str(tmp_path / "none"), schema, "w").count() == 0
