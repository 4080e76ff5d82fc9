"""Substring dedup on words by super-k-mer partitioning.

A window is ``width`` consecutive words.  Runs of windows that share a minimiser
travel as one packed string to that minimiser's bucket, where sorting counts the
windows exactly.  Every word covered by a window that occurs again, in the same
document or another, is removed in all places.

Cases: null and empty texts have no words and hash as the empty string; a text
with fewer words than ``width`` keeps all; rows equal in doc_id and text count
as separate documents, so their windows repeat; null doc_ids are ordinary
documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import _text
from ._repeats import Unit, canonical_words, removed_mask, repeated_windows, with_verdicts

MINIMISER_WORDS = 5


def count_windows(held: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (run, place in it, 1) whose total weight over the sorted windows of the buckets is over one."""
    windows, run, place = [], [], []
    for k, (data, where) in enumerate(zip(held["packed"], held["place"])):
        starts, ends = _text.word_spans(np.frombuffer(data, np.uint8))
        n = where & 0xFFFF
        windows += [data[a:b] for a, b in zip(starts[:n].tolist(), ends[width - 1 : width - 1 + n].tolist())]
        run += [k] * n
        place += range(n)
    run, place = np.array(run, np.int64), np.array(place, np.int64)
    order = sorted(range(len(windows)), key=windows.__getitem__)
    fresh = np.array([True] + [windows[a] != windows[b] for a, b in zip(order, order[1:])][: len(order)], bool)[: len(order)]
    order = np.array(order, np.int64)
    group = np.cumsum(fresh) - 1
    total = np.bincount(group, held["weight"].to_numpy()[run[order]]) if len(order) else np.empty(0)
    hit = order[total[group] > 1]
    return run[hit], place[hit], np.ones(len(hit), np.int64)


def remove_repeated_windows(docs: DataFrame, width: int = 35, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, text]) for every row of ``docs(doc_id, text)``."""
    unit = Unit("word", width, min(MINIMISER_WORDS, width))
    rows, copies, flagged = repeated_windows(docs, unit, lambda held: count_windows(held, width), keep_first=False)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, data, copies, ranges in zip(batch["doc_id"].astype(object), batch["data"], batch["copies"], batch["ranges"]):
                words, froms, tos = canonical_words(np.frombuffer(data, np.uint8))
                n, kept = len(froms), words.tobytes()
                removed = 0
                if copies > 1 and n >= width:
                    removed, kept = n, b""
                elif ranges is not None:
                    gone = removed_mask(n, ranges, width)
                    removed = int(gone.sum())
                    kept = b" ".join(kept[a:b] for a, b in zip(froms[~gone].tolist(), tos[~gone].tolist()))
                out.append((None if pd.isna(doc_id) else int(doc_id), n, removed, sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if with_text else None))
            frame = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "text"]).astype({"doc_id": "Int64"})
            yield frame if with_text else frame.drop(columns="text")

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", text string" * with_text
    return with_verdicts(rows, copies, flagged).fillna({"copies": 1}).mapInPandas(cut, schema)
