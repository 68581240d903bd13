import random

import pytest
from pyspark.sql import functions as F

from areacast.operators import clean, learn
from areacast.plans import score, train
from areacast.plans.spec import BaseSpec
from tests.conftest import rows

SPEC = BaseSpec(stations={"RECIFE": "estacao_recife", "SURUBIM": "estacao_surubim"})


@pytest.fixture(scope="module")
def base(spark):
    rng = random.Random(6)
    data = []
    for i in range(400):
        heat, people, recife = rng.uniform(25, 35), rng.randint(1000, 9000), float(rng.randint(0, 1))
        cases = int(heat - 24 + people / 2000 + 3 * recife)
        data.append((f"A{i % 20}", str(201600 + i // 20), float(cases), float(people), heat,
                     heat - 8, heat - 4, recife, 1 - recife, "original"))
    data.append(("A0", "201701", 9999.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, "previsto"))
    return spark.createDataFrame(data, score.base_schema(SPEC))


@pytest.fixture(scope="module")
def rows_and_model(base):
    rows_ = learn.training_rows(train.observed(base, SPEC), SPEC.features, SPEC.label)
    model = learn.fit(rows_, SPEC.features, learn.boosting(SPEC.label, maxIter=5, maxDepth=3))
    return rows_, model


def test_hash_split_is_complete_disjoint_and_stable(base):
    keys = [SPEC.area, SPEC.week]
    first = learn.hash_split(base, keys)
    again = learn.hash_split(base.repartition(7), keys)
    assert rows(first.select(*keys, "split")) == rows(again.select(*keys, "split"))
    counts = {r.split: r["count"] for r in first.groupBy("split").count().collect()}
    assert sum(counts.values()) == base.count()
    assert 0.6 < counts["train"] / base.count() < 0.8
    assert rows(learn.hash_split(base, keys, seed=7)) != rows(first)


def test_other_splits(spark):
    df = spark.range(100).toDF("n")
    assert learn.modulo_split(df, "n").filter("split = 'train'").count() == 70
    parts = learn.random_split(df)
    assert sum(p.count() for p in parts) == 100
    assert rows(parts[0]) == rows(learn.random_split(df)[0])


def test_metrics(spark):
    scored = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 5.0)], "y int, prediction double")
    r = learn.regression_metrics(scored, "y").first()
    assert (r.mse, r.mae, r.r2, r.baseline_mse) == pytest.approx((4 / 3, 2 / 3, -1, 2 / 3))
    assert learn.baseline_mse(scored, "y").first()[0] == pytest.approx(2 / 3)
    constant = spark.createDataFrame([(2, 1.0), (2, 2.0)], "y int, prediction double")
    assert learn.regression_metrics(constant, "y").first().r2 is None


def test_training_leaves_predictions_out(base):
    assert train.observed(base, SPEC).count() == 400


def test_saved_model_predicts_the_same(base, rows_and_model, tmp_path):
    _, model = rows_and_model
    path = str(tmp_path / "model")
    learn.save_model(model, path)
    loaded = learn.load_model(path, SPEC.features)
    columns = [SPEC.area, SPEC.week, "prediction"]
    assert rows(loaded.transform(base).select(columns)) == rows(
        model.transform(base).select(columns)
    )
    with pytest.raises(ValueError, match="features"):
        learn.load_model(path, SPEC.features[:-1])


def test_equal_seeds_give_equal_models(base, rows_and_model):
    data, model = rows_and_model
    again = learn.fit(data, SPEC.features, learn.boosting(SPEC.label, maxIter=5, maxDepth=3))
    assert rows(again.transform(base).select("prediction")) == rows(
        model.transform(base).select("prediction")
    )


def test_column_order_of_a_feature_file_does_not_matter(base, rows_and_model):
    _, model = rows_and_model
    keep = [SPEC.area, SPEC.week]
    straight = score.score_features(base, model, SPEC.features, keep)
    reversed_ = base.select(*reversed(base.columns)).drop(SPEC.label)
    assert rows(straight) == rows(score.score_features(reversed_, model, SPEC.features, keep))
    with pytest.raises(ValueError, match="temp_maxima"):
        score.score_features(base.drop("temp_maxima"), model, SPEC.features)


def test_null_feature_fails(spark, base, rows_and_model):
    from pyspark.sql import functions as F

    broken = base.withColumn("temp_maxima", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="(?i)null"):
        rows_and_model[1].transform(broken).select("prediction").collect()


def test_importance(rows_and_model):
    data, model = rows_and_model
    found = learn.feature_importance(model, data).collect()
    assert {r.feature for r in found} == set(SPEC.features)
    assert found[0].relative == 100
    assert [r.relative for r in found] == sorted((r.relative for r in found), reverse=True)


def test_train_beats_the_mean(base):
    trained = train.train(
        base, SPEC, folds=2,
        grid={"maxDepth": [3], "subsamplingRate": [0.5, 1.0], "maxIter": [5]},
    )
    metrics = trained.metrics.first()
    assert metrics.mse < metrics.baseline_mse
    report = trained.report.collect()
    assert [r.params for r in report] == [
        "maxDepth=3, maxIter=5, subsamplingRate=0.5", "maxDepth=3, maxIter=5, subsamplingRate=1.0"
    ]
    assert sum(r.is_best for r in report) == 1


def test_kinds_predict_counts(base, rows_and_model):
    data, _ = rows_and_model
    for kind in ("decision_tree", "decision_tree_classes"):
        model = learn.fit_kind(data, SPEC.features, SPEC.label, kind)
        metrics = learn.regression_metrics(
            model.transform(train.observed(base, SPEC)), SPEC.label
        ).first()
        assert metrics.n_rows == 400
        assert metrics.mse < metrics.baseline_mse


def test_the_hash_split_takes_keys_as_text(spark):
    numbers = spark.range(200).selectExpr("CAST(id AS int) AS week")
    texts = numbers.selectExpr("CAST(week AS string) AS week")
    one = {str(r.week): r.split for r in learn.hash_split(numbers, ["week"]).collect()}
    assert one == {r.week: r.split for r in learn.hash_split(texts, ["week"]).collect()}


def test_folds_follow_the_keys(spark):
    df = spark.createDataFrame([(f"a{i % 40}", 201600 + i // 40, i) for i in range(2000)], "area string, week int, v int")
    first = learn.with_folds(df, ["area", "week"], 5)
    again = learn.with_folds(df.repartition(7, "v").withColumn("week", F.col("week").cast("string")), ["area", "week"], 5)
    assert {(r.v, r.fold) for r in first.collect()} == {(r.v, r.fold) for r in again.collect()}
    sizes = [r["count"] for r in first.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and all(330 < s < 470 for s in sizes)
    assert {r.fold for r in learn.with_folds(spark.createDataFrame([(None, 1)], "area string, week int"), ["area", "week"], 5).collect()} <= set(range(5))


def test_search_is_the_same_after_repartitioning(spark):
    data = [(f"a{i % 30}", 201601 + i // 30, float(i % 11 + i % 3), float(i % 11), float(i % 7)) for i in range(600)]
    df = spark.createDataFrame(data, "area string, week int, y double, f double, g double")
    reports = []
    for rows_ in (df, df.repartition(5, "g")):
        training = learn.training_rows(rows_, ["f", "g"], "y", ["area", "week"], folds=3)
        model = learn.cross_validate(training, ["f", "g"], "y", grid={"maxDepth": [2, 3], "maxIter": [2], "subsamplingRate": [1.0]})
        assert model.getFoldCol() == learn.FOLD
        reports.append(model.avgMetrics)
    assert reports[0] == pytest.approx(reports[1], rel=1e-6)


def test_saved_imputer_fills_rows_as_means_do(spark, tmp_path):
    df = spark.createDataFrame([(1.0, None), (None, float("nan")), (4.0, 2.0)], "x double, y double")
    means = clean.column_means(df, ["x", "y"])
    imputer = learn.fit_imputer(means, ["x", "y"])
    model = learn.fit(spark.createDataFrame([(1.0, 2.0)] * 4, "y double, x double"), ["x"], learn.boosting("y", maxIter=1))
    path = str(tmp_path / "model")
    learn.save_model(model, path, "share", imputer)
    loaded = learn.load_imputer(path, ["x", "y"])
    assert learn.imputer_means(loaded) == {"x": 2.5, "y": 2.0}
    assert rows(loaded.transform(df)) == rows(clean.impute_mean(df, ["x", "y"]))
    assert learn.load_model(path, ["x"], "share").stages[0].getInputCols() == ["x"]
    with pytest.raises(ValueError, match="fills"):
        learn.load_imputer(path, ["y"])
    learn.save_model(model, path)
    assert learn.load_imputer(path) is None


def test_bands(spark):
    counts = [0.0, 1.0, 2.0, 3.0, 9.0, 10.0, 500.0]
    df = spark.createDataFrame([(c, c if c < 9 else 2.0) for c in counts], "y double, guess double")
    found = {r.band: r for r in learn.band_metrics(df, "y", "guess", of_count=True).collect()}
    assert [found[i].n_rows for i in range(5)] == [1, 2, 2, 1, 1]
    assert [found[i].n_predicted for i in range(5)] == [1, 5, 1, 0, 0]
    assert [found[i].n_hits for i in range(5)] == [1, 2, 1, 0, 0]
    assert (found[1].precision, found[1].recall, found[2].recall) == (0.4, 1.0, 0.5)
    assert (found[3].precision, found[3].recall, found[3].f1) == (None, 0.0, 0.0)
    rows_ = spark.createDataFrame([(float(i % 40), float(i % 40) + 0.1) for i in range(400)], "y double, f double")
    model = learn.fit_bands(rows_, ["f"], "y", "decision_tree")
    metrics = learn.band_metrics(model.transform(rows_), "y", "band").collect()
    assert sum(r.n_rows for r in metrics) == 400 and min(r.f1 for r in metrics if r.n_rows > 20) > 0.9
    # A count that was never seen has a band nevertheless.
    assert model.transform(spark.createDataFrame([(1e6,)], "f double")).first().band == 4
