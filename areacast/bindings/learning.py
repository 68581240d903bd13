"""Training, scoring and their metrics on the base of the test tables.

Results that SQL knows exactly use a fixed predictor in place of a model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from areacast.bindings import roles
from areacast.bindings.roles import SPEC, fixed_prediction, rounded
from areacast.operators import aggregate, learn
from areacast.plans import score, train
from areacast.plans.training_base import ROWS, training_means
from areacast.session import scratch_path
from areacast.sources import tables

QUERIES = {}
ORACLES = {}
FEATURES = SPEC.features


def _base(spark, sf_dir):
    return tables.written(roles.base(spark, sf_dir), "base")


def _training(spark, sf_dir):
    marked = learn.hash_split(_base(spark, sf_dir), ["area", "week"])
    rows = learn.training_rows(marked.filter("split = 'train'"), FEATURES, "cases")
    return rows, marked.filter("split = 'test'")


def _small_model(rows):
    return learn.fit(rows, FEATURES, learn.boosting("cases", maxIter=10, maxDepth=3))


def split_hash(spark, sf_dir):
    """Per area: its weeks, and how many marks they have got."""
    marked = learn.hash_split(roles.base(spark, sf_dir), ["area", "week"])
    return marked.groupBy("area").agg(
        F.count_distinct("week").alias("n_weeks"), F.count_distinct("week", "split").alias("n_marks")
    )


QUERIES["split_hash"] = split_hash
ORACLES["split_hash"] = f"""WITH {roles.CLEANED_SQL}
SELECT area, count(DISTINCT week) AS n_weeks, count(DISTINCT week) AS n_marks
FROM cleaned GROUP BY area"""


def split_modulo(spark, sf_dir):
    marked = learn.modulo_split(roles.base(spark, sf_dir), "week")
    return marked.select("area", "week", "split")


QUERIES["split_modulo"] = split_modulo
ORACLES["split_modulo"] = f"""WITH {roles.CLEANED_SQL}
SELECT DISTINCT area, week, CASE WHEN week % 10 < 7 THEN 'train' ELSE 'test' END AS split
FROM cleaned"""


def cv_folds(spark, sf_dir):
    """Rows per fold of the area-weeks; the folds follow from the keys alone."""
    folded = learn.with_folds(roles.base(spark, sf_dir), ["area", "week"], 5)
    return folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("cases").alias("cases"))


QUERIES["cv_folds"] = cv_folds
ORACLES["cv_folds"] = f"""WITH {roles.BASE_SQL}
SELECT CAST(CAST('0x' || substr(md5('{learn.SEED}|' || area || '|' || week), 1, 8) AS UBIGINT) % 5 AS INTEGER)
         AS fold, count(*) AS n_rows, CAST(sum(cases) AS BIGINT) AS cases
FROM base GROUP BY 1"""


def band_metrics(spark, sf_dir):
    """Bands of counts, their rows, and how well a fixed predictor meets them."""
    scored = roles.base(spark, sf_dir).withColumn("prediction", fixed_prediction())
    found = learn.band_metrics(scored, "cases", "prediction", ends=(2, 4, 8, 100), of_count=True)
    return rounded(found, "precision", "recall", "f1")


QUERIES["band_metrics"] = band_metrics
ORACLES["band_metrics"] = f"""WITH {roles.BASE_SQL},
banded AS (
  SELECT {", ".join(f"CAST(({v} >= 2) AS INTEGER) + CAST(({v} >= 4) AS INTEGER) + CAST(({v} >= 8) AS INTEGER)"
                    f" + CAST(({v} >= 100) AS INTEGER) AS {n}"
                    for v, n in (("cases", "actual"), ("cases * 0.75 + (week % 100) * 0.125", "guess")))}
  FROM base
),
counted AS (
  SELECT CAST(b AS INTEGER) AS band, (SELECT count(*) FROM banded WHERE actual = b) AS n_rows,
         (SELECT count(*) FROM banded WHERE guess = b) AS n_predicted,
         (SELECT count(*) FROM banded WHERE actual = b AND guess = b) AS n_hits
  FROM range(5) r(b)
)
SELECT band, n_rows, n_predicted, n_hits, round(n_hits / nullif(n_predicted, 0), 8) AS precision,
       round(n_hits / nullif(n_rows, 0), 8) AS recall,
       round(2 * n_hits / nullif(n_rows + n_predicted, 0), 8) AS f1
FROM counted"""


def train_bands(spark, sf_dir):
    """Held-out rows per band of a classifier of bands, and whether its guesses are bands."""
    rows, test = _by_week(spark, sf_dir)
    ends = (2, 4, 8, 100)
    model = learn.fit_bands(rows, FEATURES, "cases", "decision_tree", ends)
    found = learn.band_metrics(model.transform(test), "cases", "band", ends)
    total = found.agg(F.sum("n_predicted").alias("n")).scalar()
    return found.select("band", "n_rows", total.alias("n_predicted"))


QUERIES["train_bands"] = train_bands
ORACLES["train_bands"] = f"""WITH {roles.BASE_SQL}, held AS (SELECT cases FROM base WHERE week % 10 >= 7)
SELECT CAST(b AS INTEGER) AS band, (
         SELECT count(*) FROM held WHERE CAST((cases >= 2) AS INTEGER) + CAST((cases >= 4) AS INTEGER)
           + CAST((cases >= 8) AS INTEGER) + CAST((cases >= 100) AS INTEGER) = b) AS n_rows,
       (SELECT count(*) FROM held) AS n_predicted
FROM range(5) r(b)"""


def impute_saved(spark, sf_dir):
    """Gaps filled by the imputer that was saved with a model and loaded again, per area and week."""
    enriched = roles.enriched(spark, sf_dir)
    base = _base(spark, sf_dir)
    path = scratch_path(spark, "model")
    model = learn.fit(
        learn.training_rows(base, FEATURES, "cases"), FEATURES, learn.boosting("cases", maxIter=1, maxDepth=1)
    )
    imputer = learn.fit_imputer(training_means(enriched, SPEC), SPEC.means)
    learn.save_model(model, path, SPEC.station_encoding, imputer)
    loaded = learn.load_imputer(path, SPEC.means)
    filled = score.clean_request(enriched, SPEC, loaded)
    return rounded(
        aggregate.area_week_base(filled, "area", "week", SPEC.means, "cases", ROWS), *SPEC.means
    )


QUERIES["impute_saved"] = impute_saved
ORACLES["impute_saved"] = f"""WITH {roles.CLEANED_SQL}
SELECT area, week, count(*) AS cases, {", ".join(f"round(avg({m}), 8) AS {m}" for m in SPEC.means)}
FROM cleaned GROUP BY area, week"""


def regression_metrics(spark, sf_dir):
    scored = roles.base(spark, sf_dir).withColumn("prediction", fixed_prediction())
    metrics = learn.regression_metrics(scored, "cases", by=["area"])
    return rounded(metrics, "r2", "mse", "mae", "baseline_mse")


QUERIES["regression_metrics"] = regression_metrics
ORACLES["regression_metrics"] = f"""WITH {roles.BASE_SQL},
scored AS (SELECT area, cases, cases * 0.75 + (week % 100) * 0.125 AS prediction FROM base)
SELECT area, count(*) AS n_rows,
       round(1 - avg((prediction - cases) * (prediction - cases)) / nullif(var_pop(cases), 0), 8)
         AS r2,
       round(avg((prediction - cases) * (prediction - cases)), 8) AS mse,
       round(avg(abs(prediction - cases)), 8) AS mae,
       round(var_pop(cases), 8) AS baseline_mse
FROM scored GROUP BY area"""


def baseline_mse(spark, sf_dir):
    return rounded(learn.baseline_mse(roles.base(spark, sf_dir), "cases"), "baseline_mse")


QUERIES["baseline_mse"] = baseline_mse
ORACLES["baseline_mse"] = f"""WITH {roles.BASE_SQL}
SELECT round(var_pop(cases), 8) AS baseline_mse FROM base"""


def _by_week(spark, sf_dir):
    """Training rows and held-out rows by a split that SQL knows."""
    marked = learn.modulo_split(_base(spark, sf_dir), "week")
    rows = learn.training_rows(marked.filter("split = 'train'"), FEATURES, "cases")
    return rows, marked.filter("split = 'test'")


def train_gbt(spark, sf_dir):
    """Held-out rows per area, and how many of them a second seeded fit predicts the same."""
    rows, test = _by_week(spark, sf_dir)
    first = _small_model(rows).transform(test).drop("features")
    both = _small_model(rows).transform(first.withColumnRenamed("prediction", "first"))
    return both.groupBy("area").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("first") == F.col("prediction")).alias("n_equal"),
    )


QUERIES["train_gbt"] = train_gbt
ORACLES["train_gbt"] = f"""WITH {roles.BASE_SQL}
SELECT area, count(*) AS n_rows, count(*) AS n_equal FROM base WHERE week % 10 >= 7 GROUP BY area"""


def _trained(spark, sf_dir):
    base = _base(spark, sf_dir)
    return base, train.train(base, SPEC)


def cv_grid(spark, sf_dir):
    """Rows of the training and of the held-out share, and parameter sets with the best one."""
    base, trained = _trained(spark, sf_dir)
    held_out = trained.metrics.select("n_rows", F.expr("mse >= 0 AND mae >= 0").alias("measured"))
    learned = learn.hash_split(base, ["area", "week"]).where("split = 'train'").agg(
        F.count(F.lit(1)).alias("n_train")
    )
    sets = trained.report.agg(
        F.count(F.lit(1)).alias("n_sets"), F.count_if("is_best").alias("n_best")
    )
    # Three tables of one row.
    one = F.lit(1)
    joined = held_out.withColumn("k", one).join(learned.withColumn("k", one), "k").join(
        sets.withColumn("k", one), "k"
    )
    return joined.select(
        (F.col("n_rows") + F.col("n_train")).alias("n_rows"), "n_sets", "n_best", "measured"
    )


def cv_report(spark, sf_dir):
    """The parameter sets, and how many of all are the best."""
    report = _trained(spark, sf_dir)[1].report
    best = report.agg(F.count_if("is_best").alias("n_best"))
    return report.select("params", best.scalar().alias("n_best"))


QUERIES["cv_grid"] = cv_grid
ORACLES["cv_grid"] = f"""WITH {roles.BASE_SQL}
SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_sets, CAST(1 AS BIGINT) AS n_best,
       true AS measured FROM base"""
QUERIES["cv_report"] = cv_report
ORACLES["cv_report"] = """
SELECT 'maxDepth=' || depth || ', maxIter=10, subsamplingRate=' || rate AS params,
       CAST(1 AS BIGINT) AS n_best
FROM (VALUES ('3'), ('6')) d(depth), (VALUES ('0.5'), ('1.0')) r(rate)"""


def feature_importance(spark, sf_dir):
    """The features; their importances sum to 1 and the largest one is set to 100."""
    rows, _ = _training(spark, sf_dir)
    found = learn.feature_importance(_small_model(rows), rows)
    total = found.agg(F.round(F.sum("importance"), 6).alias("total"))
    top = found.agg(F.max("relative").alias("top"))
    return found.select("feature", total.scalar().alias("total"), top.scalar().alias("top"))


QUERIES["feature_importance"] = feature_importance
ORACLES["feature_importance"] = f"""
SELECT feature, CAST(1 AS DOUBLE) AS total, CAST(100 AS DOUBLE) AS top
FROM (VALUES {", ".join(f"('{f}')" for f in FEATURES)}) f(feature)"""


def _known(spark, sf_dir):
    """Training rows whose label follows from one feature, and all rows with it."""
    base = _base(spark, sf_dir).withColumn("cases", F.when(F.col("population") > 2500, 12.0).otherwise(2.0))
    marked = learn.modulo_split(base, "week")
    return learn.training_rows(marked.filter("split = 'train'"), FEATURES, "cases"), marked


def feature_importance_known(spark, sf_dir):
    """Importances where the label follows from the population alone."""
    rows, _ = _known(spark, sf_dir)
    model = learn.fit(rows, FEATURES, learn.boosting("cases", maxIter=1, maxDepth=1))
    return rounded(learn.feature_importance(model, rows), "importance", "relative")


QUERIES["feature_importance_known"] = feature_importance_known
ORACLES["feature_importance_known"] = f"""
SELECT feature, CASE WHEN feature = 'population' THEN 1.0::DOUBLE ELSE 0 END AS importance,
       CASE WHEN feature = 'population' THEN 100.0::DOUBLE ELSE 0 END AS relative
FROM (VALUES {", ".join(f"('{f}')" for f in FEATURES)}) f(feature)"""


def train_known(spark, sf_dir):
    """What trees predict per area where the label follows from the population, and their metrics."""
    rows, marked = _known(spark, sf_dir)
    found = None
    for kind, estimator in (
        ("boosting", learn.boosting("cases", maxIter=2, maxDepth=2)),
        ("decision_tree", learn.REGRESSORS["decision_tree"]("cases", learn.SEED)),
    ):
        scored = learn.fit(rows, FEATURES, estimator).transform(marked.filter("split = 'test'"))
        own = learn.regression_metrics(scored, "cases", by=["area"]).join(
            scored.groupBy("area").agg(F.sum("prediction").alias("predicted")), "area"
        ).select(F.lit(kind).alias("kind"), "area", "n_rows", "predicted", "mse", "mae")
        found = own if found is None else found.unionByName(own)
    return rounded(found, "predicted", "mse", "mae", digits=6)


QUERIES["train_known"] = train_known
ORACLES["train_known"] = f"""WITH {roles.BASE_SQL}
SELECT k.kind, area, count(*) AS n_rows,
       round(sum(CASE WHEN population > 2500 THEN 12.0::DOUBLE ELSE 2 END), 6) AS predicted,
       0::DOUBLE AS mse, 0::DOUBLE AS mae
FROM base, (VALUES ('boosting'), ('decision_tree')) k(kind) WHERE week % 10 >= 7 GROUP BY k.kind, area"""


def train_alternatives(spark, sf_dir):
    """The kinds of models with the rows they were measured on."""
    rows, test = _by_week(spark, sf_dir)
    compared = learn.compare_kinds(rows, test, FEATURES, "cases")
    return compared.select("kind", "n_rows", F.expr("mse >= 0 AND mae >= 0").alias("measured"))


QUERIES["train_alternatives"] = train_alternatives
ORACLES["train_alternatives"] = f"""WITH {roles.BASE_SQL}
SELECT kind, (SELECT count(*) FROM base WHERE week % 10 >= 7) AS n_rows, true AS measured
FROM (VALUES {", ".join(f"('{k}')" for k in learn.REGRESSORS)}) k(kind)"""


def model_roundtrip(spark, sf_dir):
    """Rows per area, and how many of them a saved and loaded model predicts the same."""
    base = _base(spark, sf_dir)
    model = _small_model(learn.training_rows(base, FEATURES, "cases"))
    path = scratch_path(spark, "model")
    learn.save_model(model, path)
    loaded = learn.load_model(path, FEATURES)
    first = model.transform(base).drop("features").withColumnRenamed("prediction", "first")
    both = loaded.transform(first)
    return both.groupBy("area").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("first") == F.col("prediction")).alias("n_equal"),
    )


QUERIES["model_roundtrip"] = model_roundtrip
ORACLES["model_roundtrip"] = f"""WITH {roles.BASE_SQL}
SELECT area, count(*) AS n_rows, count(*) AS n_equal FROM base GROUP BY area"""


def request_base(spark, sf_dir):
    """All station observations as one request, with the request's own means."""
    weather = roles.obs(spark, sf_dir).select("obs_station", "obs_date", *SPEC.measures)
    base = score.request_base(weather, roles.areas(spark, sf_dir), SPEC)
    return rounded(base, *SPEC.means)


_REQUEST_SQL = f"""{roles.AREAS_SQL},{roles.OBS_SQL},
expanded AS (
  SELECT obs_station, obs_date, dim_area, population, temp_max, temp_min, temp_mean
  FROM obs LEFT JOIN areas ON obs_station = station
),
request AS (
  SELECT upper(coalesce(dim_area, 'SEM_INFORMACAO')) AS area,
         CAST(extract(isoyear FROM obs_date) * 100 + extract(week FROM obs_date) AS INTEGER)
           AS week,
         replace(obs_station, 'MIDDLE EAST', 'MIDDLE_EAST') AS station,
         coalesce(population, (SELECT avg(population) FROM expanded)) AS population,
         {", ".join(f"coalesce({m}, (SELECT avg({m}) FROM expanded)) AS {m}"
                    for m in SPEC.measures)}
  FROM expanded
)"""
QUERIES["request_base"] = request_base
ORACLES["request_base"] = f"""WITH {_REQUEST_SQL}
SELECT r.*, {", ".join(f"s.{n}" for n in SPEC.stations.values())}
FROM (SELECT area, week, count(*) AS n_observations,
             {", ".join(f"round(avg({m}), 8) AS {m}" for m in SPEC.means)}
      FROM request GROUP BY area, week) r
JOIN (SELECT area, {", ".join(
    f"CAST(count(*) FILTER (WHERE station = '{v}') AS DOUBLE) AS {n}"
    for v, n in SPEC.stations.items())}
      FROM request GROUP BY area) s ON r.area = s.area"""


def request_base_share(spark, sf_dir):
    """The same request with the stations as shares of the area's rows of the week."""
    weather = roles.obs(spark, sf_dir).select("obs_station", "obs_date", *SPEC.measures)
    base = score.request_base(weather, roles.areas(spark, sf_dir), roles.SHARE_SPEC)
    return rounded(base, *SPEC.means, *SPEC.stations.values())


QUERIES["request_base_share"] = request_base_share
ORACLES["request_base_share"] = f"""WITH {_REQUEST_SQL}
SELECT area, week, count(*) AS n_observations,
       {", ".join(f"round(avg({m}), 8) AS {m}" for m in SPEC.means)},
       {", ".join(f"round(avg(CASE WHEN station = '{v}' THEN 1.0 ELSE 0.0 END), 8) AS {n}"
                  for v, n in SPEC.stations.items())}
FROM request GROUP BY area, week"""


def score_batch(spark, sf_dir):
    """A request scored as a whole and as a file of its features: rows and equal predictions per area."""
    rows, _ = _training(spark, sf_dir)
    model = _small_model(rows)
    weather = roles.obs(spark, sf_dir).select("obs_station", "obs_date", *SPEC.measures)
    areas = roles.areas(spark, sf_dir)
    base = tables.written(score.request_base(weather, areas, SPEC), "request")
    predicted = score.score(weather, areas, model, SPEC).select("area", "week", "cases")
    shuffled = base.select("area", "week", *reversed(FEATURES))
    from_file = score.score_features(shuffled, model, FEATURES, keep=["area", "week"])
    both = predicted.join(from_file, ["area", "week"])
    return both.groupBy("area").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("week").alias("n_weeks"),
        # Means of the same numbers can differ in their last digits.
        F.count_if(F.abs(F.col("cases") - F.col("prediction")) < 1e-6).alias("n_equal"),
    )


QUERIES["score_batch"] = score_batch
ORACLES["score_batch"] = f"""WITH {_REQUEST_SQL}
SELECT area, count(DISTINCT week) AS n_rows, count(DISTINCT week) AS n_weeks,
       count(DISTINCT week) AS n_equal
FROM request GROUP BY area"""


def training_publish(spark, sf_dir):
    """Score, publish into the stored base twice, and count what is stored."""
    base = _base(spark, sf_dir)
    path = scratch_path(spark, "published")
    score.store(base, path, SPEC)
    model = _small_model(learn.training_rows(base, FEATURES, "cases"))
    weather = roles.obs(spark, sf_dir).select("obs_station", "obs_date", *SPEC.measures)
    predicted = score.score(weather, roles.areas(spark, sf_dir), model, SPEC)
    for _ in range(2):
        score.publish(predicted, path, SPEC)
    stored = tables.read_folder(spark, path, score.base_schema(SPEC))
    return stored.groupBy("kind", "area").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("week").alias("n_weeks")
    )


QUERIES["publish_predictions"] = training_publish
ORACLES["publish_predictions"] = f"""WITH {roles.BASE_SQL},
request AS (
  SELECT upper(coalesce(dim_area, 'SEM_INFORMACAO')) AS area,
         extract(isoyear FROM obs_date) * 100 + extract(week FROM obs_date) AS week
  FROM obs LEFT JOIN areas ON obs_station = station
)
SELECT kind, area, count(*) AS n_rows, count(DISTINCT week) AS n_weeks FROM base GROUP BY 1, 2
UNION ALL
SELECT 'previsto', area, count(DISTINCT week), count(DISTINCT week) FROM request GROUP BY area"""
