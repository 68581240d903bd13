"""Training on a base: only observed rows, a hash split, grid search, hold-out metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.fixed import OBSERVED
from areacast.operators import learn
from areacast.plans.spec import BaseSpec


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    report: DataFrame
    metrics: DataFrame
    importance: DataFrame


def observed(base: DataFrame, spec: BaseSpec = BaseSpec()) -> DataFrame:
    """Rows that were observed: predictions that were merged in are no training data."""
    return base.filter(F.col(spec.kind) == OBSERVED)


def train(
    base: DataFrame,
    spec: BaseSpec = BaseSpec(),
    train_share: float = 0.7,
    seed: int = learn.SEED,
    folds: int = 3,
    **cv,
) -> Trained:
    """Grid search on the training share, with folds by key; metrics on the rest."""
    keys = [spec.area, spec.week]
    marked = learn.hash_split(observed(base, spec), keys, train_share, seed)
    rows = learn.training_rows(
        marked.filter("split = 'train'"), spec.features, spec.label, keys, folds, seed
    )
    searched = learn.cross_validate(rows, spec.features, spec.label, folds=folds, seed=seed, **cv)
    model = searched.bestModel
    held_out = model.transform(marked.filter("split = 'test'"))
    return Trained(
        model=model,
        report=learn.cv_report(searched, rows),
        metrics=learn.regression_metrics(held_out, spec.label),
        importance=learn.feature_importance(model, rows),
    )
