import random

import pytest

from areacast.operators import merge, report
from tests.conftest import rows

SCHEMA = "area string, week string, cases double, kind string"


def merged(history, new, mode):
    return merge.merge_predictions(history, new, ["area", "week"], mode, "week", "cases", "kind")


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(
        [("A", "201701", 3.0, "original"), ("A", "201701", 2.0, "previsto"),
         ("B", "201701", 1.0, "previsto")],
        SCHEMA,
    )


def test_union_distinct_keeps_both_predictions(spark, history):
    new = spark.createDataFrame(
        [("previsto", 5.0, 201701, "A"), ("previsto", 1.0, 201701, "B")],
        "kind string, cases double, week int, area string",
    )
    assert rows(merged(history, new, "union_distinct")) == [
        ("A", "201701", 2.0, "previsto"), ("A", "201701", 3.0, "original"),
        ("A", "201701", 5.0, "previsto"), ("B", "201701", 1.0, "previsto"),
    ]


def test_replace_by_key_keeps_the_last_prediction_and_all_history(spark, history):
    new = spark.createDataFrame([("A", 201701, 5.0, "previsto")], "area string, week int, "
                                "cases double, kind string")
    assert rows(merged(history, new, "replace_by_key")) == [
        ("A", "201701", 3.0, "original"), ("A", "201701", 5.0, "previsto"),
        ("B", "201701", 1.0, "previsto"),
    ]


def test_unknown_mode(history):
    with pytest.raises(ValueError, match="mode"):
        merged(history, history, "append")


def test_actual_vs_predicted(spark):
    base = spark.createDataFrame(
        [("A", "201607", 4.0, "original"), ("A", "201707", 6.0, "previsto"),
         ("A", "201608", 0.0, "original"), ("A", "201708", 1.0, "previsto"),
         ("B", "201707", 2.0, "previsto")],
        SCHEMA,
    )
    found = rows(report.actual_vs_predicted(base, "area", "week", "cases", "kind"))
    assert found == [
        ("A", 7, 4.0, 6.0, 2.0, 50.0), ("A", 8, 0.0, 1.0, 1.0, None),
        ("B", 7, None, 2.0, None, None),
    ]


@pytest.mark.parametrize("top", [None, 5, 1000])
def test_ranking_matches_brute_force(spark, top):
    rng = random.Random(5)
    # many areas share a total, so ties have to be ranked by name
    areas = {f"area{i:03}": 1.0 if rng.random() < 0.6 else float(rng.randint(2, 30))
             for i in range(300)}
    data = [(a, "201701", v, "previsto") for a, v in areas.items()]
    data += [("area000", "201710", 99.0, "previsto"), ("area000", "201701", 99.0, "original")]
    ranked = report.campaign_ranking(
        spark.createDataFrame(data, SCHEMA).repartition(8), 201701, 201708, top,
        "area", "week", "cases", "kind",
    )
    order = sorted(areas.items(), key=lambda i: (-i[1], i[0]))
    total, so_far, expected = sum(areas.values()), 0.0, {}
    for rank, (area, value) in enumerate(order, 1):
        so_far += value
        if top is None or rank <= top:
            expected[area] = (value, rank, so_far / total)
    found = {r.area: (r.predicted, r["rank"], r.cumulative_share) for r in ranked.collect()}
    assert found.keys() == expected.keys()
    for area, row in expected.items():
        assert found[area] == pytest.approx(row)
