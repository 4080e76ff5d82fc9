"""Suffix-array dedup on bytes with longest-previous-factor arrays.

A byte goes if a string of ``width`` bytes that covers it also starts earlier
(smaller doc_id, or the same document further left); the first occurrence stays.
Strings that may repeat are brought together by their minimiser; within the
buckets, laid out in document order, a suffix array is built, and the previous and
next smaller positions in suffix order give each position's longest earlier
match: the longest-previous-factor array.  A window goes where that is ``width``
or more.  Of runs, windows of very large buckets and whole texts that are equal,
only the first enters a bucket: the longest previous factor of the others is known
to reach their end.  Matches never cross a document's end.

Cases: null and empty texts have no bytes and hash as the empty string; a text
of fewer bytes than ``width`` keeps all; rows equal in doc_id and text are one
document and get the same result; null doc_ids come after all others, ordered by
a hash of the text; texts that are not null but differ under one doc_id are
ordered by that hash too; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._repeats import Unit, known_verdicts, removed_mask, repeated_windows, row_key, with_verdicts

MINIMISER_BYTES = 24


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.uint64)


class SuffixOrder:
    """Order and common prefixes of the suffixes of ``data``, by prefix doubling.

    Suffixes are told apart in their first ``depth`` bytes; past its end the data
    goes on with zero bytes, so callers bound what they read by what is left.
    """

    def __init__(self, data: np.ndarray, depth: int):
        self.n, reach = len(data), 3 * max(depth, 8) + 16
        padded = np.zeros(self.n + reach + 16, np.uint8)
        padded[: self.n] = data
        self.eight = np.ndarray(self.n + reach, ">u8", padded.data, strides=(1,)).astype(np.uint64)
        self.levels = [(8, self._padded(_ranks(self.eight[: self.n + 1])))]  # the rank at n stands for all that lies beyond
        while 2 * self.levels[-1][0] < depth:
            length, rank = self.levels[-1]
            self.levels.append((2 * length, self._padded(_ranks(rank[: self.n + 1] * np.uint64(self.n + 2) + rank[length : self.n + 1 + length]))))

    def _padded(self, rank: np.ndarray) -> np.ndarray:
        return np.concatenate([rank, np.full(len(self.eight) - len(rank), rank[-1], np.uint64)])

    def suffix_array(self, positions: np.ndarray) -> np.ndarray:
        """Numbers of the ascending positions in the order of their suffixes, equal ones by position."""
        length, rank = self.levels[-1]
        return np.argsort(rank[positions] * np.uint64(self.n + 2) + rank[positions + length], kind="stable")

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each pair of suffixes (as far as they are told apart)."""
        a, b, begin = a.copy(), b.copy(), a
        for length, rank in [self.levels[-1], *self.levels[::-1]]:
            same = length * (rank[a] == rank[b])
            a += same
            b += same
        differ = self.eight[a] ^ self.eight[b]
        for k in range(7):  # equal leading bytes of the eight that differ
            a += differ < np.uint64(1 << (56 - 8 * k))
        return a - begin


def smaller_before(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value to the left of each (all values differ), -1 where there is none.

    What lies between an entry and the one it points to is larger, so a pointer to
    a larger value can be replaced by that value's own pointer.
    """
    to = np.arange(len(values)) - 1
    live = np.flatnonzero(to >= 0)
    live = live[values[to[live]] > values[live]]
    while len(live):
        to[live] = to[to[live]]
        live = live[to[live] >= 0]
        live = live[values[to[live]] > values[live]]
    return to


def longest_previous_factors(data: np.ndarray, positions: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each of the ascending positions the longest prefix of its suffix that also starts at an earlier one.

    ``left`` is how many bytes a match may have at each position.  The longest
    match is with the previous or the next smaller position in suffix order.
    """
    n = len(positions)
    if not n:
        return np.empty(0, np.int64)
    order = SuffixOrder(data, int(left.max()))
    suffixes = order.suffix_array(positions)
    before = smaller_before(suffixes)
    after = n - 1 - smaller_before(suffixes[::-1])[::-1]
    at, rest = positions[suffixes], left[suffixes]
    found = np.zeros(n, np.int64)
    for near in (before, after):
        here = np.flatnonzero((near >= 0) & (near < n))
        there = near[here]
        match = order.common(at[here], at[there])
        found[here] = np.maximum(found[here], np.minimum(match, np.minimum(rest[here], rest[there])))
    out = np.empty(n, np.int64)
    out[suffixes] = found
    return out


def earlier_windows(held: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (run, first, number) of the runs, laid out in document order, that also start earlier."""
    data = np.frombuffer(b"".join(held["packed"]), np.uint8)
    lengths = held["packed"].map(len).to_numpy()
    at = np.cumsum(lengths) - lengths
    n = (held["place"].to_numpy() & 0xFFFF).astype(np.int64)
    run = np.repeat(np.arange(len(n)), n)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    hit = longest_previous_factors(data, at[run] + inner, lengths[run] - inner) >= width
    begins = hit & ~np.concatenate([[False], hit[:-1] & (run[:-1] == run[1:])])
    ends = hit & ~np.concatenate([hit[1:] & (run[:-1] == run[1:]), [False]])
    a, b = np.flatnonzero(begins), np.flatnonzero(ends)
    return run[a], inner[a], b - a + 1


def remove_later_copies(docs: DataFrame, width: int = 100, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, text]) for every row of ``docs(doc_id, text)``.

    ``text`` has the bytes that stay; a character that a cut goes through becomes U+FFFD.
    """
    unit = Unit("byte", width, MINIMISER_BYTES)
    rows, copies, flagged = repeated_windows(docs, unit, lambda held: earlier_windows(held, width), keep_first=True)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, data, first, ranges in zip(batch["doc_id"].astype(object), batch["data"], batch["first"], batch["ranges"]):
                n, removed, spans, kept = len(data), 0, 0, data
                if first is False and n >= width:
                    removed, spans, kept = n, 1, b""
                elif ranges is not None:
                    raw = np.frombuffer(data, np.uint8)
                    gone = removed_mask(n, ranges, width)
                    removed, kept = int(gone.sum()), raw[~gone].tobytes()
                    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                out.append((None if pd.isna(doc_id) else int(doc_id), n, removed, spans, sha256(kept).hexdigest(), bytes(kept).decode("utf-8", "replace") if with_text else None))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]).astype({"doc_id": "Int64"})
            yield frame if with_text else frame.drop(columns="text")

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", text string" * with_text
    return with_verdicts(rows, copies, flagged).mapInPandas(cut, schema)


def without_later_copies(docs: DataFrame, width: int = 100) -> DataFrame:
    """``docs`` with later copies cut out of ``text``, and ``n_chars``, if there, set to the new length; all rows stay.

    A null text stays null; a character that a cut goes through is taken out whole.
    """
    unit = Unit("byte", width, MINIMISER_BYTES)
    _, copies, flagged = repeated_windows(docs.select("doc_id", "text"), unit, lambda held: earlier_windows(held, width), keep_first=True)
    known = known_verdicts(copies, flagged)

    @F.pandas_udf("string")
    def cut(data: pd.Series, first: pd.Series, starts: pd.Series, counts: pd.Series) -> pd.Series:
        out = []
        for text, is_first, begin, number in zip(data, first, starts, counts):
            if text is None:
                out.append(None)
            elif is_first is False and len(text) >= width:
                out.append("")
            elif begin is None:
                out.append(bytes(text).decode("utf-8", "replace"))
            else:
                gone = removed_mask(len(text), [{"start": a, "count": n} for a, n in zip(begin, number)], width)
                out.append(np.frombuffer(text, np.uint8)[~gone].tobytes().decode("utf-8", "ignore"))
        return pd.Series(out, dtype=object)

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_key().alias("rid"))
    rows = rows.join(known, "rid", "left")
    rows = rows.select("doc", cut(F.col("doc.text").cast("binary"), "first", F.col("ranges.start"), F.col("ranges.count")).alias("kept"))
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return rows.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
