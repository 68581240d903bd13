"""Toxicity scores by logistic regression, learned with FTRL-proximal updates.

Features are hashed words, word pairs and skip-grams (a word and the next but one), each counted once
per text. Per-coordinate rates and L1 keep most weights at exactly zero, so the model is a short list
of (slot, weight) that is broadcast whatever the corpus' size: at most ``2 ** bits`` numbers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.llm import words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TIMES = np.uint64(0xD6E8FEB86659FD93)
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


@dataclass(frozen=True)
class Settings:
    """``sample``: the most labelled ids that are learned from, the smallest by a seeded hash of the id."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.01
    epochs: int = 4
    sample: int = 20_000
    seed: int = 6


def _slots(text: bytes | None, ids: words.WordIds, bits: int) -> np.ndarray:
    """The slots of a text's features, with repetitions."""
    own = ids.of(text.translate(_FOLD).split()) if text else np.empty(0, np.uint64)
    turned = own * _TIMES
    pairs = turned[:-1] ^ (own[1:] >> np.uint64(7)) ^ np.uint64(0x51)
    skips = turned[:-2] ^ (own[2:] >> np.uint64(9)) ^ np.uint64(0xA7)
    mixed = np.concatenate([own, pairs, skips]) * _TIMES
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _fit(features: list[np.ndarray], labels: list[int], settings: Settings) -> np.ndarray:
    """The weights, with the bias last, after some passes in a seeded order."""
    size = (1 << settings.bits) + 1
    z, n, weights = np.zeros(size), np.zeros(size), np.zeros(size)
    draw = np.random.Generator(np.random.PCG64(settings.seed))
    for _ in range(settings.epochs):
        for i in draw.permutation(len(labels)):
            at = features[i]
            zs, ns = z[at], n[at]
            # The bias is not regularized.
            l1 = np.where(at == size - 1, 0.0, settings.l1)
            old = np.where(
                np.abs(zs) <= l1, 0.0,
                -(zs - np.sign(zs) * l1)
                / ((settings.beta + np.sqrt(ns)) / settings.alpha + settings.l2),
            )
            p = 1 / (1 + np.exp(-np.clip(old.sum(), -35, 35)))
            g = p - labels[i]
            rate = (np.sqrt(ns + g * g) - np.sqrt(ns)) / settings.alpha
            z[at] = zs + g - rate * old
            n[at] = ns + g * g
    l1 = np.full(size, settings.l1)
    l1[-1] = 0
    weights = np.where(
        np.abs(z) <= l1, 0.0,
        -(z - np.sign(z) * l1) / ((settings.beta + np.sqrt(n)) / settings.alpha + settings.l2),
    )
    return weights


def train(
    docs: DataFrame, labels: DataFrame, id_column: str, label: str, text: str = "text",
    settings: Settings = Settings(),
) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) that are not zero, learned from the labelled texts; the bias has the last slot.

    Rows without a label of 0 or 1 or without a matching id are not learned from. Without any labelled
    row there is no weight and every score is 0.
    """
    marks = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).select(
        F.col(id_column), F.col(label).cast("int").alias("label")
    )
    order = F.xxhash64(F.lit(settings.seed), id_column)
    marks = marks.groupBy(id_column).agg(F.max("label").alias("label"))
    marks = marks.orderBy(order, id_column).limit(settings.sample)
    # At most ``sample`` rows of two numbers: bounded, so the texts need no shuffle.
    rows = docs.select(id_column, F.col(text).alias("text")).join(F.broadcast(marks), id_column)
    rows = rows.select(order.alias("order"), "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = words.WordIds()
        features, marks, places = [], [], []
        bias = np.array([1 << settings.bits])
        for batch in batches:
            for order, text, mark in zip(
                batch.column(0).to_pylist(), words.texts(batch.column(1)), batch.column(2).to_pylist()
            ):
                own = np.unique(_slots(text, ids, settings.bits))
                features.append(np.concatenate([own, bias]).astype(np.int32))
                marks.append(mark)
                places.append(order)
        if not marks:
            return
        by_order = sorted(range(len(marks)), key=lambda i: (places[i], len(features[i])))
        weights = _fit([features[i] for i in by_order], [marks[i] for i in by_order], settings)
        kept = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.int64()), pa.array(weights[kept], pa.float64())], ["slot", "weight"]
        )

    learned = rows.repartition(1).mapInArrow(run, "slot bigint, weight double").toArrow()
    return learned.column("slot").to_numpy(), learned.column("weight").to_numpy()


def score(
    docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """All rows with a column ``score`` from 0 to 1; null and empty texts have no features, just the bias."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)
    columns = [c for c in docs.columns if c.lower() != "score"]

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        slots, weights = shared.value
        dense = np.zeros((1 << settings.bits) + 1)
        dense[slots] = weights
        ids = words.WordIds()
        for texts in batches:
            sums = np.empty(len(texts))
            for i, value in enumerate(texts):
                at = _slots(value.encode() if value else None, ids, settings.bits)
                # Only features with a weight need to be told apart.
                at = np.unique(at[dense[at] != 0])
                sums[i] = dense[at].sum() + dense[-1]
            known = len(slots) > 0
            yield pd.Series(known / (1 + np.exp(-np.clip(sums, -35, 35))))

    return docs.select(*columns, scored(F.col(text)).alias("score"))
