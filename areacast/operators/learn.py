"""Splits, feature pipelines, training, cross validation, metrics and importances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (
    Bucketizer,
    Imputer,
    ImputerModel,
    IndexToString,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.sources.tables import folder_exists, written

SEED = 42


def hash_split(
    df: DataFrame, keys: Sequence[str], train_share: float = 0.7, seed: int = SEED,
    name: str = "split",
) -> DataFrame:
    """Mark each row ``train`` or ``test`` by a hash of its key.

    The mark depends on the text of the key alone, not on its type, partitions or row order, so it is the
    same after a retry, in every run, and for stored and computed bases.
    """
    texts = [F.col(k).cast("string") for k in keys]
    bucket = F.pmod(F.xxhash64(F.lit(seed), *texts), F.lit(1_000_000))
    is_train = bucket < int(train_share * 1_000_000)
    return df.withColumn(name, F.when(is_train, "train").otherwise("test"))


def modulo_split(
    df: DataFrame, number: str, train_of: int = 7, of: int = 10, name: str = "split"
) -> DataFrame:
    """Mark each row by the remainder of a number it carries."""
    is_train = F.pmod(F.col(number), F.lit(of)) < train_of
    return df.withColumn(name, F.when(is_train, "train").otherwise("test"))


def random_split(
    df: DataFrame, shares: Sequence[float] = (0.7, 0.3), seed: int = SEED
) -> list[DataFrame]:
    """Spark's own random split, always seeded."""
    return df.randomSplit(list(shares), seed)


def assembler(features: Sequence[str]) -> VectorAssembler:
    """Feature columns to one vector; a null fails instead of dropping the row."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def boosting(label: str, seed: int = SEED, **params) -> GBTRegressor:
    return GBTRegressor(labelCol=label, featuresCol="features", seed=seed, **params)


FOLD = "fold"


def with_folds(
    df: DataFrame, keys: Sequence[str], folds: int, seed: int = SEED, name: str = FOLD
) -> DataFrame:
    """Number the fold of each row, 0 to ``folds`` - 1, by a hash of its key.

    The number follows from the text of the key alone, so folds stay the same whatever the order and the partitions of the rows. The
    hash is the first 8 hexadecimal digits of the md5 of seed and key, joined by ``|``, which other engines can follow.
    """
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *texts)), 1, 8)
    number = F.conv(digits, 16, 10).cast("bigint")
    return df.withColumn(name, F.pmod(number, F.lit(folds)).cast("int"))


def training_rows(
    base: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = (), folds: int = 0,
    seed: int = SEED,
) -> DataFrame:
    """Label and features only, written once: training reads them many times.

    With ``keys`` and ``folds`` also the fold of each row, see :func:`with_folds`.
    """
    columns = [F.col(label).cast("double").alias(label), *[F.col(f) for f in features]]
    if folds:
        base = with_folds(base, keys, folds, seed, "_fold")
        columns.append(F.col("_fold").alias(FOLD))
    return written(base.select(*columns), "training")


def fit(rows: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    """Fit assembler and estimator as one pipeline, so a saved model knows its features."""
    return Pipeline(stages=[assembler(features), estimator]).fit(rows)


# Fixed values -- the parameter grids of the model search.
GRID = {"maxDepth": [3, 6], "subsamplingRate": [0.5, 1.0], "maxIter": [10]}
SLOW_GRID = {
    "maxDepth": [3],
    "subsamplingRate": [0.5],
    "maxIter": [500],
    "stepSize": [0.01],
    "minInstancesPerNode": [5],
}
GRIDS = {"default": GRID, "slow": SLOW_GRID}
FOLDS = {"default": 3, "slow": 5}


def boosting_grid(estimator: GBTRegressor, grid: Mapping[str, Sequence] = GRID) -> list:
    """All combinations of the named parameters."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def cross_validate(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    grid: Mapping[str, Sequence] = GRID,
    folds: int = 3,
    metric: str = "r2",
    seed: int = SEED,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Grid search over boosting parameters with k folds.

    Folds are those that :func:`training_rows` has numbered, so that a repartitioned or repeated read splits alike. Rows without
    them are split by a seeded random number per row, which is the same only if the rows come in a fixed order.
    """
    estimator = boosting(label, seed)
    search = CrossValidator(
        estimator=Pipeline(stages=[assembler(features), estimator]),
        estimatorParamMaps=boosting_grid(estimator, grid),
        evaluator=RegressionEvaluator(labelCol=label, metricName=metric),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    return (search.setFoldCol(FOLD) if FOLD in rows.columns else search).fit(rows)


def cv_report(model: CrossValidatorModel, rows: DataFrame) -> DataFrame:
    """Mean metric and twice its standard deviation per parameter set; the best one, the first of equal ones,
    is marked."""
    larger_better = model.getEvaluator().isLargerBetter()
    best = model.avgMetrics.index((max if larger_better else min)(model.avgMetrics))
    lines = []
    for number, (params, mean, std) in enumerate(zip(
        model.getEstimatorParamMaps(), model.avgMetrics, model.stdMetrics, strict=True
    )):
        shown = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda i: i[0].name))
        lines.append((shown, float(mean), 2 * float(std), number == best))
    return rows.sparkSession.createDataFrame(
        lines, "params string, mean_metric double, spread double, is_best boolean"
    )


def regression_metrics(
    scored: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """R2, MSE, MAE and the MSE of always predicting the mean, in one aggregate."""
    actual, predicted = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = predicted - actual
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.lit(1.0) - F.avg(error * error) / F.nullif(F.var_pop(actual), F.lit(0.0))).alias("r2"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(actual).alias("baseline_mse"),
    )


def baseline_mse(rows: DataFrame, label: str) -> DataFrame:
    """MSE of always predicting the mean label."""
    return rows.agg(F.var_pop(F.col(label).cast("double")).alias("baseline_mse"))


def feature_importance(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Importance per feature, the largest set to 100, in descending order.

    The names come from the model's own assembler. One row per feature.
    """
    names = model.stages[0].getInputCols()
    values = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    top = max(values) or 1.0
    lines = [(n, v, 100.0 * v / top) for n, v in zip(names, values, strict=True)]
    return rows.sparkSession.createDataFrame(
        lines, "feature string, importance double, relative double"
    ).orderBy(F.col("relative").desc(), "feature")


REGRESSORS = {
    "boosting": lambda label, seed: boosting(label, seed),
    "decision_tree": lambda label, seed: DecisionTreeRegressor(
        labelCol=label, featuresCol="features", seed=seed
    ),
    "random_forest": lambda label, seed: RandomForestRegressor(
        labelCol=label, featuresCol="features", seed=seed, numTrees=100
    ),
}
CLASSIFIERS = {
    "logistic_classes": lambda seed: LogisticRegression(labelCol="_class"),
    "decision_tree_classes": lambda seed: DecisionTreeClassifier(labelCol="_class", seed=seed),
    "random_forest_classes": lambda seed: RandomForestClassifier(
        labelCol="_class", seed=seed, numTrees=100
    ),
}


def fit_kind(
    rows: DataFrame, features: Sequence[str], label: str, kind: str, seed: int = SEED
) -> PipelineModel:
    """Fit one of the model kinds.

    The ``_classes`` kinds take each count as a class of its own; their model gives the
    count of the predicted class as ``prediction``.
    """
    if kind in REGRESSORS:
        return fit(rows, features, REGRESSORS[kind](label, seed))
    vectors = assembler(features)
    indexer = StringIndexer(inputCol=label, outputCol="_class", stringOrderType="alphabetAsc")
    classes = indexer.fit(rows)
    classifier = CLASSIFIERS[kind](seed).setPredictionCol("_predicted")
    fitted = classifier.fit(classes.transform(vectors.transform(rows)))
    back: Transformer = IndexToString(
        inputCol="_predicted", outputCol="_count", labels=list(classes.labels)
    )
    number = SQLTransformer(statement="SELECT *, CAST(_count AS DOUBLE) AS prediction FROM __THIS__")
    return PipelineModel(stages=[vectors, fitted, back, number])


#: Upper ends of the count bands: fixed values.
BANDS = (1.0, 3.0, 10.0, 30.0)
BAND_CLASSIFIERS = {
    "logistic": lambda seed: LogisticRegression(labelCol="_band"),
    "decision_tree": lambda seed: DecisionTreeClassifier(labelCol="_band", seed=seed),
    "random_forest": lambda seed: RandomForestClassifier(labelCol="_band", seed=seed, numTrees=100),
}


def bucketizer(column: str, band: str, ends: Sequence[float] = BANDS) -> Bucketizer:
    """Counts to bands: band 0 is below the first end, band i from the i-th end to below the next one."""
    splits = [float("-inf"), *ends, float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol=band, handleInvalid="error")


def fit_bands(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    kind: str = "random_forest",
    ends: Sequence[float] = BANDS,
    seed: int = SEED,
) -> PipelineModel:
    """A classifier of the band of the count; its model gives the number of the band as ``band``.

    The bands are declared, so their number does not grow with the data as that of distinct counts does.
    """
    vectors = assembler(features)
    marked = bucketizer(label, "_band", ends).transform(vectors.transform(rows))
    classifier = BAND_CLASSIFIERS[kind](seed).setPredictionCol("band")
    return PipelineModel(stages=[vectors, classifier.fit(marked)])


def band_metrics(
    scored: DataFrame, label: str, predicted: str, ends: Sequence[float] = BANDS, of_count: bool = False
) -> DataFrame:
    """Rows, predicted rows, hits, precision, recall and F1 of each declared band, those without rows included.

    ``predicted`` holds numbers of bands, or counts that are put into bands first (``of_count``).
    """
    banded = bucketizer(label, "_actual", ends).transform(
        scored.select(F.col(label).cast("double").alias(label), F.col(predicted).cast("double").alias("_given"))
    )
    if of_count:
        banded = bucketizer("_given", "_guess", ends).transform(banded)
    else:
        banded = banded.withColumnRenamed("_given", "_guess")
    # Rows shrink to one per pair of bands before they are dealt to both.
    pairs = banded.groupBy("_actual", "_guess").agg(F.count(F.lit(1)).alias("_n"))
    sides = F.array(
        *[
            F.struct(F.col(side).cast("int").alias("band"), F.lit(i).alias("side"))
            for i, side in enumerate(("_actual", "_guess"))
        ]
    )
    each = pairs.select(F.explode(sides).alias("s"), "_n", (F.col("_actual") == F.col("_guess")).alias("hit"))
    declared = F.sequence(F.lit(0), F.lit(len(ends)))
    bands = scored.sparkSession.range(1).select(F.explode(declared).alias("band"))
    counted = each.groupBy(F.col("s.band").alias("band")).agg(
        F.sum(F.when(F.col("s.side") == 0, F.col("_n"))).alias("n_rows"),
        F.sum(F.when(F.col("s.side") == 1, F.col("_n"))).alias("n_predicted"),
        F.sum(F.when((F.col("s.side") == 0) & F.col("hit"), F.col("_n"))).alias("n_hits"),
    )
    full = bands.join(counted, "band", "left").fillna(0)
    hits = F.col("n_hits").cast("double")
    return full.withColumns({
        "precision": hits / F.nullif(F.col("n_predicted"), F.lit(0)),
        "recall": hits / F.nullif(F.col("n_rows"), F.lit(0)),
        "f1": 2 * hits / F.nullif(F.col("n_rows") + F.col("n_predicted"), F.lit(0)),
    })


def compare_kinds(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    kinds: Sequence[str] = tuple(REGRESSORS),
    seed: int = SEED,
) -> DataFrame:
    """Metrics of each kind on the test rows; the kinds that take counts as classes on request."""
    reports = []
    for kind in kinds:
        model = fit_kind(train, features, label, kind, seed)
        scored = model.transform(test).select(label, "prediction")
        reports.append(regression_metrics(scored, label).withColumn("kind", F.lit(kind)))
    return reduce(DataFrame.unionByName, reports)


def fit_imputer(means: DataFrame, names: Sequence[str]) -> ImputerModel:
    """Spark ML's imputer that fills nulls and NaN with given means, the one row of :func:`clean.column_means`.

    The means of training are taken over case rows, before these become area-weeks, so they are not
    the means of the rows that the model learns from: the imputer is fitted on the means themselves.
    """
    row = means.select(*[F.col(n).cast("double").alias(n) for n in names])
    return Imputer(strategy="mean", inputCols=list(names), outputCols=list(names)).fit(row)


def imputer_means(imputer: ImputerModel) -> dict[str, float]:
    """The numbers that an imputer fills with."""
    return imputer.surrogateDF.select(*imputer.getInputCols()).first().asDict()


def save_model(
    model: PipelineModel, path: str, encoding: str | None = None, imputer: ImputerModel | None = None
) -> None:
    """Save a pipeline, and with it how the station columns it learned from are encoded and what fills its gaps."""
    model.write().overwrite().save(path)
    if imputer is not None:
        PipelineModel(stages=[imputer]).write().overwrite().save(f"{path}/rows")
    if encoding is not None:
        spark = SparkSession.active()
        spark.createDataFrame([(encoding,)], "encoding string").coalesce(1).write.mode(
            "overwrite"
        ).json(f"{path}/encoding")


def load_imputer(path: str, names: Sequence[str] | None = None) -> ImputerModel | None:
    """The row-level imputer of a saved model; None if it was saved without. With ``names`` it has to fill these."""
    if not folder_exists(SparkSession.active(), f"{path}/rows"):
        return None
    imputer = PipelineModel.load(f"{path}/rows").stages[0]
    if names is not None and imputer.getInputCols() != list(names):
        raise ValueError(f"the model fills {imputer.getInputCols()}")
    return imputer


def load_model(
    path: str, features: Sequence[str] | None = None, encoding: str | None = None
) -> PipelineModel:
    """Load a pipeline; with ``features`` its assembler has to take exactly these, with ``encoding`` it
    has to be saved with that one."""
    model = PipelineModel.load(path)
    if encoding is not None:
        stored = SparkSession.active().read.schema("encoding string").json(f"{path}/encoding").first()
        if stored["encoding"] != encoding:
            raise ValueError(f"the model takes stations as {stored['encoding']}, not {encoding}")
    if features is not None and model.stages[0].getInputCols() != list(features):
        raise ValueError(f"the model takes the features {model.stages[0].getInputCols()}")
    return model
