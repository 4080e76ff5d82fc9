"""Bounded labelled samples for the classifiers, and one-dimensional calibration."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

T = TypeVar("T")
#: Bytes of text that a classifier is fitted on at most.
TRAIN_BYTES = 32 << 20


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id's text leaves 1 modulo 3; a null doc_id isn't held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(h, doc_id, label, data): at most ``bound`` labelled whole texts that aren't held out, told apart by a hash of doc_id.

    Ids are chosen from the label table first, so that only the chosen texts
    travel.  Rows with a null or odd label, doc_id or text are passed over.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .where(~held_out())
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(bound)
    )
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data"))
        .where("data is not null and doc_id is not null")
        .join(F.broadcast(chosen), "doc_id")  # at most ``bound`` ids
        .select(F.xxhash64("doc_id").alias("h"), "doc_id", "label", "data")
    )


def trained(docs: DataFrame, labels: DataFrame, label: str, bound: int, train: Callable[[list[tuple[bytes, int]]], T], max_bytes: int | None = None) -> T:
    """What ``train`` makes of the labelled sample, in one task; the driver gets the model alone.

    The sample comes in the order of its hash, equal texts once, and has ``bound``
    rows at most.  A text that would take it over ``max_bytes`` (``TRAIN_BYTES``, if
    not given) is passed over, and the texts after it still count.
    """
    most = TRAIN_BYTES if max_bytes is None else max_bytes

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, int] = {}
        size = 0
        for batch in batches:
            for data, y in zip(batch["data"], batch["label"]):
                data = bytes(data)
                if data not in seen and size + len(data) <= most:
                    size += len(data)
                    seen[data] = int(y)
        yield pd.DataFrame({"model": [pickle.dumps(train(list(seen.items())))]})

    sample = labelled_sample(docs, labels, label, bound)
    ordered = sample.repartition(1).sortWithinPartitions("h", "doc_id", "label", "data").select("label", "data")
    row = ordered.mapInPandas(fit, "model binary").first()
    return pickle.loads(bytes(row["model"])) if row else train([])  # an empty sample has no task


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, weight: np.ndarray | None = None, rounds: int = 50) -> np.ndarray:
    """Coefficients (slopes and, last, the intercept) of a logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    weight = np.ones(len(y)) if weight is None else weight
    penalty = np.full(len(w), ridge)
    penalty[-1] = 0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + penalty * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
