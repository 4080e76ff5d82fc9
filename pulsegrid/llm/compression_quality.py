"""Quality scores from two zstandard dictionaries.

One dictionary is built from good, one from bad labelled text.  A text is cut
into pieces of ``PIECE`` bytes, all of them, each piece is compressed with either
dictionary, and (bad size - good size) / (length + ``SHRINK``) is the feature: the
pieces keep a dictionary's influence up over long texts, the constant draws very
short texts to the middle.  A logistic curve fitted on labelled texts that the dictionaries
have not seen turns it into a probability.

The labelled sample is bounded by ``TRAIN_ROWS`` and in bytes (see ``_labelled``), and
a task of its own trains on it.  Cases: null and empty texts get the
curve's value at 0; very long texts go through piece by piece; without labels of both kinds every score is 0.5; repeated
rows are scored alike; null doc_ids stay null and count as not held out; an empty table gives an empty
result; columns other than id and text, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._labelled import fit_logistic, held_out, sigmoid, trained

TRAIN_ROWS = 3000
PIECE = 512
DICTIONARY_BYTES = 32768
LEVEL = 3
SHRINK = 48


def pieces(data: bytes) -> list[bytes]:
    return [data[k : k + PIECE] for k in range(0, len(data), PIECE)]


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples' own bytes where there are too few to train on."""
    import zstandard

    parts = [p for s in samples for p in pieces(s)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


class SizeDifference:
    """The normalised compressed-size difference of one text."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self._good, self._bad = (
            zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
            for d in (good, bad)
        )

    def __call__(self, data: bytes) -> float:
        parts = pieces(data)
        good = sum(len(self._good.compress(p)) for p in parts)
        bad = sum(len(self._bad.compress(p)) for p in parts)
        return (bad - good) / (len(data) + SHRINK)


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float


def train(sample: list[tuple[bytes, int]]) -> QualityModel | None:
    """Dictionaries from the even rows of the sample, the curve from the odd ones."""
    build, tune = sample[::2], sample[1::2]
    good, bad = [d for d, y in build if y == 1 and d], [d for d, y in build if y == 0 and d]
    if not good or not bad or len({y for _, y in tune}) < 2:
        return None
    good, bad = build_dictionary(good), build_dictionary(bad)
    feature = SizeDifference(good, bad)
    x = np.array([feature(d) for d, _ in tune])
    slope, intercept = fit_logistic(x[:, None] * 10, np.array([y for _, y in tune], float), ridge=1e-2)
    return QualityModel(good, bad, float(slope) * 10, float(intercept))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs(doc_id, text)``."""
    model = trained(docs, labels, "quality", TRAIN_ROWS, train)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        feature = SizeDifference(model.good, model.bad) if model else None
        for batch in batches:
            x = np.array([feature(d) for d in batch["data"]], float) if feature else np.zeros(len(batch))
            p = sigmoid(model.slope * x + model.intercept) if model else np.full(len(batch), 0.5)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": p, "predicted": (p >= threshold).astype("int32")})

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"),
    )
    return rows.mapInPandas(score, "doc_id bigint, held_out boolean, score double, predicted int")
