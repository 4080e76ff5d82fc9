"""Quality rules with tokeniser fertility.

Besides plain counts (words, symbols, repeated lines, words in repeated 5-word
windows), a public SentencePiece vocabulary measures each whole text, word by word:
characters per token, the share of byte-fallback tokens, and the entropy of the
token distribution.  A text is rejected by its fertility if a measure lies outside
the band of its language (its script, where the language column has no code of two
or three letters) and size class.  The bands are the quartiles over the whole
corpus, widened by ``fence`` times their distance (at least ``slack`` of the
median), so they follow a corpus without rejecting its ordinary texts.  As the measures
change with the size, a class of fewer than ``least_class`` texts takes in the size classes next to
it on either side, one, two and then four; if these have too few as well, a text is held against
its script at such sizes, then its language over all sizes, its script, and else the whole corpus.

Cases: null and empty texts have no words, fail the base rules and have no measure
(null); words of any length are measured whole; repeated rows count as often as they
occur in the bands; null doc_ids stay null; an empty table gives an empty result;
columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._shared import materialise

BATCH_BYTES = 1 << 20
MEMO = 400_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
SCRIPTS = ("none", "latin", "greek-cyrillic", "semitic", "indic", "cjk", "hangul", "other")
_LEAD = np.zeros(256, np.int64)  # script by the first byte of a letter in UTF-8
_LEAD[0x41:0x5B] = _LEAD[0x61:0x7B] = _LEAD[0xC3:0xCA] = 1
_LEAD[0xCD:0xD5] = 2
_LEAD[0xD6:0xE0] = 3
_LEAD[0xE0] = 4
_LEAD[0xE1:0xE3] = 7
_LEAD[0xE3:0xEA] = 5
_LEAD[0xEA:0xEE] = 6
_LEAD[0xEE:0xF8] = 7


@dataclass(frozen=True)
class FertilityRules:
    """Base limits, and how wide the bands are."""

    least_words: int = 10
    most_repeat_percent: int = 20
    repeat_window: int = 5
    fence: float = 2.0
    slack: float = 0.02
    least_class: int = 20


class WordPieces:
    """Memo of the pieces of words (by hash) under one vocabulary."""

    def __init__(self, model_file: str):
        import sentencepiece

        self._sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.is_byte = np.array([self._sp.is_byte(i) for i in range(self._sp.get_piece_size())])
        self._memo: dict[int, bytes] = {}

    def ids(self, hashes: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, how many each word has)."""
        keys = hashes.tolist()
        found = list(map(self._memo.get, keys))
        fresh = [k for k, v in enumerate(found) if v is None]
        if fresh:
            if len(self._memo) > MEMO:
                self._memo.clear()
            words = [data[a:b].decode("utf-8", "replace") for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())]
            for k, ids in zip(fresh, self._sp.encode(words, num_threads=1)):
                found[k] = self._memo[keys[k]] = np.array(ids, np.int32).tobytes()
        return np.frombuffer(b"".join(found), np.int32), np.array([len(f) // 4 for f in found], np.int64)


@lru_cache(maxsize=2)
def word_pieces(model_file: str) -> WordPieces:
    return WordPieces(model_file)


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\r\v\f")]
    return len(lines) - len(set(lines))


def measure(texts: list[bytes], pieces: WordPieces, window: int) -> pd.DataFrame:
    """Counts and token measures of each text."""
    n_texts = len(texts)
    lengths = np.array([len(t) + 1 for t in texts])
    joined = b" ".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    ends_of = np.cumsum(lengths)
    starts, ends = _text.word_spans(data)
    text = np.searchsorted(ends_of, starts, "right")
    hashes = _text.span_hashes(data, starts, ends)
    n_words = np.bincount(text, minlength=n_texts)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(ends_of, np.flatnonzero(mask), "right"), minlength=n_texts)

    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word_chars = np.bincount(text, chars[ends] - chars[starts], n_texts).astype(np.int64)

    repeat = np.zeros(n_texts, np.int64)
    if len(hashes) >= window:
        grams = _text.windows_hash(hashes, window)
        at = np.flatnonzero(text[: len(grams)] == text[window - 1 :])
        keys = _text.mix(grams[at] + text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
        again = at[count[inverse] > 1]
        step = np.zeros(len(hashes) + 1, np.int64)
        step[again] += 1
        np.add.at(step, again + window, -1)
        repeat = np.bincount(text, np.cumsum(step[:-1]) > 0, n_texts).astype(np.int64)

    unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    ids, counts = pieces.ids(unique, joined, starts[first], ends[first])
    offsets = np.cumsum(counts) - counts
    own = counts[inverse]
    n_tokens = np.bincount(text, own, n_texts).astype(np.int64)
    n_bytes = np.bincount(text, np.bincount(np.repeat(np.arange(len(counts)), counts), pieces.is_byte[ids], len(counts))[inverse], n_texts).astype(np.int64)
    flat = ids[np.repeat(offsets[inverse] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))]
    keys, often = np.unique(np.repeat(text, own) * len(pieces.is_byte) + flat, return_counts=True)
    weighted = np.bincount(keys // len(pieces.is_byte), often * np.log2(np.maximum(often, 1)), n_texts)
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = np.where(n_tokens > 0, np.log2(np.maximum(n_tokens, 1)) - weighted / np.maximum(n_tokens, 1), np.nan)
        per_token = np.where(n_tokens > 0, word_chars / np.maximum(n_tokens, 1), np.nan)
        byte_share = np.where(n_tokens > 0, n_bytes / np.maximum(n_tokens, 1), np.nan)
    script = np.stack([per_text(_LEAD[data] == k) for k in range(1, len(SCRIPTS))], axis=1)
    return pd.DataFrame(
        {
            "n_words": n_words,
            "word_chars": word_chars,
            "n_symbols": per_text(_SYMBOL[data]),
            "n_dup_lines": [repeated_lines(t) for t in texts],
            "n_repeat_words": repeat,
            "n_tokens": n_tokens,
            "chars_per_token": per_token.round(9),
            "byte_share": byte_share.round(9),
            "token_entropy": entropy.round(9),
            "script": [SCRIPTS[k + 1] if most else SCRIPTS[0] for k, most in zip(script.argmax(1), script.max(1))],
        }
    )


MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_tokens bigint, chars_per_token double, byte_share double, token_entropy double, script string"


def measured(docs: DataFrame, model_file: str, rules: FertilityRules) -> DataFrame:
    """(doc_id, lang and the measures) of every row of ``docs(doc_id, text[, lang])``."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = word_pieces(model_file)
        for batch in batches:
            cuts, size = [0], 0
            for k, data in enumerate(batch["data"], 1):
                size += len(data)
                if size > BATCH_BYTES or k == len(batch):
                    cuts.append(k)
                    size = 0
            for a, b in zip(cuts, cuts[1:]):
                part = batch.iloc[a:b]
                out = measure(list(part["data"]), pieces, rules.repeat_window)
                yield out.assign(doc_id=part["doc_id"].to_numpy(), lang=part["lang"].to_numpy())

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data")
    )
    return rows.mapInPandas(work, f"doc_id bigint, lang string, {MEASURES}")


#: What a text is held against, the first that has enough texts: columns of its class, and how far its sizes reach (None: all).
LEVELS: tuple[tuple[str | None, int | None], ...] = (
    ("band", 0), ("band", 1), ("band", 2), ("band", 4), ("script", 2), ("band", None), ("script", None), (None, None),
)
FIGURES = ("chars_per_token", "byte_share", "token_entropy")


def histogram(rows: DataFrame) -> DataFrame:
    """(band, script, size_class, measure, value, n): how often each value, rounded to hundredths, occurs in a class."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.round(m, 2).alias("value")) for m in FIGURES])
    values = rows.where("n_tokens > 0").select("band", "script", "size_class", F.inline(pairs))
    return values.groupBy("band", "script", "size_class", "measure", "value").agg(F.count("*").alias("n"))


def bands(values: DataFrame, rules: FertilityRules, level: int) -> DataFrame:
    """(columns of the level's class, and a struct ``limits_<level>`` of a low and high limit of each measure); a row a class.

    ``values`` is a :func:`histogram`, so a value counts in the classes around its own without a row of a text being copied.
    """
    column, reach = LEVELS[level]
    keys = [c for c in (column, "size_class" if reach is not None else None) if c]
    if reach:
        values = values.withColumn("size_class", F.explode(F.sequence(F.col("size_class") - reach, F.col("size_class") + reach)))
    quartiles = F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75)])
    parts = values.groupBy(*keys, "measure").agg(F.sum("n").alias("n"), F.percentile("value", quartiles, F.col("n")).alias("q"))
    wide = parts.groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("measure") == m, F.col("q"))).alias(m) for m in FIGURES])
    limits = []
    for m in FIGURES:
        least = F.lit(0.05) if m == "byte_share" else F.col(m)[1] * rules.slack
        width = rules.fence * F.greatest(F.col(m)[2] - F.col(m)[0], least)
        limits += [(F.col(m)[0] - width).alias(f"{m}_low"), (F.col(m)[2] + width).alias(f"{m}_high")]
    if keys:
        wide = wide.where(F.col("n") >= rules.least_class)
    return wide.select(*keys, F.struct(*limits).alias(f"limits_{level}"))


def judge_quality(docs: DataFrame, model_file: str, rules: FertilityRules = FertilityRules()) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and the token measures of every row of ``docs(doc_id, text)``."""
    size = F.least(F.greatest(F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))), F.lit(3)), F.lit(16))
    band = F.when(F.col("lang").rlike("^[a-z]{2,3}$"), F.col("lang")).otherwise(F.col("script"))
    rows = materialise(measured(docs, model_file, rules).withColumns({"size_class": size.cast("int"), "band": band}), "measures")
    judged, values = rows, materialise(histogram(rows), "histogram")
    for level, (column, reach) in enumerate(LEVELS):  # codes of two or three letters or a script, in 14 size classes: at most 260,000 rows
        keys = [c for c in (column, "size_class" if reach is not None else None) if c]
        limits = F.broadcast(bands(values, rules, level))
        judged = judged.join(limits, keys, "left") if keys else judged.crossJoin(limits)
    judged = judged.withColumn("limits", F.coalesce(*[f"limits_{k}" for k in range(len(LEVELS))]))
    odd = F.lit(False)
    for m in FIGURES:
        odd = odd | F.coalesce((F.col(m) < F.col(f"limits.{m}_low")) | (F.col(m) > F.col(f"limits.{m}_high")), F.lit(False))
    base = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.most_repeat_percent * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~odd).alias("kept"), "n_tokens", "chars_per_token", "byte_share", "token_entropy", "band",
    )
