"""Pairwise moments against pandas, with missing values pair by pair."""

import numpy as np
import pandas as pd
import pytest

from areacast.operators import moments, profile


@pytest.fixture(scope="module")
def wide():
    """121 columns: some shifted far from zero, some constant, each with gaps of its own."""
    rng = np.random.default_rng(12)
    frame = pd.DataFrame(rng.normal(size=(700, 121)), columns=[f"c{i}" for i in range(121)])
    for i in range(0, 121, 5):
        frame[f"c{i}"] = frame[f"c{i}"] * 1e-3 + 1e7
    for i in range(1, 121, 7):
        frame[f"c{i}"] += 0.5 * frame["c2"]
    frame["c9"], frame["c10"] = 0.1, np.nan
    for i in range(3, 121):
        frame.loc[rng.random(700) < 0.2, f"c{i}"] = np.nan
    return frame


def test_wide_table_in_one_scan(spark, wide, tmp_path):
    path = str(tmp_path / "wide")
    plain = wide.astype(object).where(wide.notna(), None)
    plain.loc[::50, "c11"] = float("nan")
    spark.createDataFrame(list(plain.itertuples(index=False, name=None)), ", ".join(f"`{c}` double" for c in wide)).repartition(
        6).write.parquet(path)
    expected = wide.copy()
    expected.loc[::50, "c11"] = np.nan
    # Shifted first: the subtraction is exact here, and the sums below keep their digits.
    expected = (expected - expected.bfill().iloc[0]).corr()
    names = list(wide.columns)
    matrix = profile.correlation_matrix(spark.read.parquet(path), names)
    found = matrix.collect()
    assert len(found) == 121 * 121
    for r in found:
        if r.feature_1 == r.feature_2 and r.feature_1 not in ("c9", "c10"):
            assert r.correlation == pytest.approx(1)
        elif "c10" in (r.feature_1, r.feature_2) or "c9" in (r.feature_1, r.feature_2):
            assert r.correlation is None
        else:
            assert r.correlation == pytest.approx(expected.loc[r.feature_1, r.feature_2], abs=1e-11)
    plan = matrix._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1


def test_blocks_of_columns_give_the_same(spark, wide):
    names = [f"c{i}" for i in range(11)]
    df = spark.createDataFrame(wide[names]).repartition(3)
    whole = {(r[0], r[1]): r for r in moments.pair_moments(df, names).collect()}
    cut = {(r[0], r[1]): r for r in moments.pair_moments(df, names, block=4).collect()}
    assert set(whole) == set(cut) and len(whole) == 66
    for pair, r in whole.items():
        assert cut[pair].n == r.n
        for name in ("c11", "c22", "c12"):
            assert (cut[pair][name] is None) == (r[name] is None)
            assert r[name] is None or cut[pair][name] == pytest.approx(r[name], rel=1e-6, abs=1e-9)


def test_pairs_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a double, b int")
    found = profile.correlation_matrix(df, ["a", "b"]).collect()
    assert sorted((r.feature_1, r.feature_2, r.correlation) for r in found) == [
        ("a", "a", None), ("a", "b", None), ("b", "a", None), ("b", "b", None)
    ]
    assert profile.correlation_pairs(df, ["a", "b"]).count() == 0


def test_constant_in_several_tasks_is_no_direction(spark):
    df = spark.createDataFrame([(0.1 + 0.2, float(i)) for i in range(1000)], "a double, b double").repartition(7)
    found = {(r.feature_1, r.feature_2): r.correlation for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert found[("a", "b")] is None and found[("a", "a")] is None and found[("b", "b")] == pytest.approx(1)
