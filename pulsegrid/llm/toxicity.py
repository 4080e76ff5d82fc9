"""Toxicity scores from a small convolutional text classifier trained in numpy.

A word's embedding is the mean of hashed rows: one for the whole word and one for
each of its byte n-grams (with word boundaries).  Filters of several widths run
over the words of the whole text, each filter's maximum over all positions goes
through a rectifier, and a logistic unit gives the raw score.  The probability is
calibrated by language on labelled texts the filters were not trained on, so that
one threshold on the calibrated score is a threshold of its own for each
language.  The language is found in the text itself by its function words; the
column of that name is never read.

The labelled sample is bounded by ``TRAIN_ROWS`` and in bytes (see ``_labelled``), and a
task of its own trains on it; the model that comes back and goes to all tasks is one
table of ``ROWS`` embeddings and a few small matrices.  The embeddings' first dimension starts from the
evidence that single features give in the sample, which is what small samples live on.

Cases: null and empty texts and texts without a word get the score of no filter
firing; without labels of both kinds every score is 0.5; repeated rows are scored
alike; null doc_ids stay null and count as not held out; an empty table gives an
empty result; columns other than id and text are ignored.  A very long text goes
through in slices of ``STEP`` words that overlap, so memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._labelled import fit_logistic, held_out, sigmoid, trained

TRAIN_ROWS = 5000
ROWS = 1 << 16
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 12
GRAMS = (4, 6)
LEAST_DOCS = 3  # features of fewer training texts stay at zero
SURE = 2.0  # standard errors that a bucket's first weight is lowered by
FOLDS = 3
STEPS, BATCH, EPOCHS, RATE = 250, 32, (2, 8), 0.05
STEP = 100_000
WORDS = 20_000  # distinct words whose features are looked at once
BATCH_BYTES = 1 << 19

#: Common function words that tell languages apart.
FUNCTION_WORDS = {
    "en": "the and of to that with was for from this are have you not",
    "de": "der die das und ist den ein eine mit dem für nicht auf sich",
    "fr": "le les et des est une dans avec elle pour pas sur qui du",
    "es": "el los las una para con por del como más pero su al no",
}

_SEPARATES = np.arange(256, dtype=np.uint8)
_SEPARATES[[b for b in range(128) if not chr(b).isalnum()]] = 0x20
_SEPARATES[65:91] += 32


@dataclass
class Words:
    """Words of some texts: ``ids`` (with two blanks, number ``n``, after each text), where each text begins, features by word."""

    ids: np.ndarray
    begins: np.ndarray
    hashes: np.ndarray
    buckets: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.hashes)


def _gram_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, offsets): hashed features of each word, the whole word and its bounded byte n-grams."""
    n = len(starts)
    lengths = ends - starts + 2
    first = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    word = np.repeat(np.arange(n, dtype=np.int32), lengths)
    inner = (np.arange(total) - first[word]).astype(np.int32)
    flat = np.where(inner == 0, np.uint8(0x3C), np.uint8(0x3E))
    body = (inner > 0) & (inner < lengths[word] - 1)
    flat[body] = data[(inner + starts[word] - 1)[body]]
    words, found = [np.arange(n, dtype=np.int32)], [(hashes >> np.uint64(48)).astype(np.uint16)]
    for k in GRAMS:
        at = np.flatnonzero(inner + k <= lengths[word]).astype(np.int32)
        gram = np.full(len(at), k, np.uint64)
        for j in range(k):
            gram = gram * np.uint64(0x100000001B3) + flat[at + j]
        words.append(word[at])
        found.append((_text.mix(gram) >> np.uint64(48)).astype(np.uint16))
    words = np.concatenate(words)
    order = np.argsort(words, kind="stable")
    return np.concatenate(found)[order], np.concatenate([[0], np.cumsum(np.bincount(words, minlength=n))])


def words_of(texts: list[bytes]) -> Words:
    lengths = np.array([len(t) + 1 for t in texts])
    data = _SEPARATES[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    starts, ends = _text.word_spans(data)
    each = [_text.span_hashes(data, starts[k : k + STEP], ends[k : k + STEP]) for k in range(0, len(starts), STEP)]
    hashes, at, ids = np.unique(np.concatenate([np.empty(0, np.uint64), *each]), return_index=True, return_inverse=True)
    grams = [_gram_features(data, starts[at[k : k + WORDS]], ends[at[k : k + WORDS]], hashes[k : k + WORDS]) for k in range(0, len(at), WORDS)]
    buckets = np.concatenate([np.empty(0, np.uint16), *[b for b, _ in grams]])
    offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.empty(0, np.int64), *[np.diff(o) for _, o in grams]]))])
    per_text = np.diff(np.searchsorted(starts, np.cumsum(lengths)), prepend=0)
    begins = np.concatenate([[0], np.cumsum(per_text + 2)])
    padded = np.full(begins[-1], len(hashes), np.int64)
    padded[np.arange(len(ids)) + 2 * np.repeat(np.arange(len(texts)), per_text)] = ids
    return Words(padded, begins, hashes, buckets, offsets)


@dataclass
class ConvModel:
    table: np.ndarray
    filters: list[np.ndarray]  # for each width: (width, DIM, FILTERS)
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float
    curves: dict[str, tuple[float, float]] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        """Without the rows of the table that are all zero."""
        used = np.flatnonzero(self.table.any(1))
        return self.__dict__ | {"table": (used.astype(np.uint16), self.table[used])}

    def __setstate__(self, state: dict) -> None:
        used, rows = state["table"]
        table = np.zeros((ROWS, DIM), np.float32)
        table[used] = rows
        self.__dict__.update(state | {"table": table})

    def embed(self, w: Words) -> np.ndarray:
        """One row a word and a zero row for the blank."""
        out = np.zeros((w.n + 1, DIM), np.float32)
        for a in range(0, w.n, WORDS):
            at = w.offsets[a : a + WORDS + 1]
            out[a : a + len(at) - 1] = np.add.reduceat(self.table[w.buckets[at[0] : at[-1]]], at[:-1] - at[0], axis=0) / np.diff(at)[:, None]
        return out

    def raw(self, w: Words) -> np.ndarray:
        rows = self.embed(w)
        projected = rows @ np.concatenate([f for block in self.filters for f in block], axis=1)
        pooled = np.full((len(w.begins) - 1, FILTERS * len(WIDTHS)), -np.inf, np.float32)
        padded = np.concatenate([w.ids, np.full(2, w.n)])
        for a in range(0, len(w.ids), STEP):
            ids = padded[a : a + STEP + 2]
            n = min(STEP, len(w.ids) - a)
            text = np.searchsorted(w.begins, a, "right") - 1
            last = np.searchsorted(w.begins, a + n, "left")
            cuts = np.maximum(w.begins[text:last] - a, 0)
            col = 0
            for i, width in enumerate(WIDTHS):
                got = np.zeros((n, FILTERS), np.float32)
                for j in range(width):
                    got += projected[ids[j : j + n], col : col + FILTERS]
                    col += FILTERS
                got[ids[:n] == w.n] = 0  # a window at a blank sees blanks only, not the next text
                part = slice(i * FILTERS, (i + 1) * FILTERS)
                pooled[text:last, part] = np.maximum(pooled[text:last, part], np.maximum.reduceat(got, cuts, axis=0))
        return np.maximum(pooled + np.concatenate(self.shifts), 0) @ self.out + self.bias

    def score(self, texts: list[bytes]) -> np.ndarray:
        w = words_of(texts)
        z = self.raw(w).astype(float)
        languages = language_of(w)
        slope, intercept = np.array([self.curves.get(x, self.curves[""]) for x in languages]).reshape(-1, 2).T
        return sigmoid(slope * z + intercept)


_LANGUAGE_KEYS = {
    name: np.sort(_text.span_hashes(d := _text.to_bytes(words), *_text.word_spans(d))) for name, words in FUNCTION_WORDS.items()
}


def language_of(w: Words) -> list[str]:
    """The language with the largest share of function words in each text; '' where none is found."""
    names = list(_LANGUAGE_KEYS)
    member = np.zeros((w.n + 1, len(names)), np.int64)
    for k, keys in enumerate(_LANGUAGE_KEYS.values()):
        member[:-1, k] = np.isin(w.hashes, keys)
    text = np.repeat(np.arange(len(w.begins) - 1), np.diff(w.begins))
    counts = np.column_stack([np.bincount(text, member[w.ids, k], len(w.begins) - 1) for k in range(len(names))]).reshape(-1, len(names))
    return [names[k] if most else "" for k, most in zip(counts.argmax(1), counts.max(1))]


def buckets_of_texts(w: Words) -> list[np.ndarray]:
    """The distinct feature buckets of each text."""
    counts = np.diff(w.offsets)
    out = []
    for a, b in zip(w.begins, w.begins[1:]):
        own = np.unique(w.ids[a:b])[:-1]  # the last is the blank
        at = np.repeat(w.offsets[own] - np.cumsum(counts[own]) + counts[own], counts[own]) + np.arange(int(counts[own].sum()))
        out.append(np.unique(w.buckets[at]))
    return out


def evidence(own: list[np.ndarray], y: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(by how much a bucket's presence at least raises the log odds of a toxic text, in how many of the texts it occurs)."""
    seen = np.zeros((2, ROWS))
    for r in rows:
        seen[y[r], own[r]] += 1
    n = np.bincount(y[rows], minlength=2)
    clean, toxic = seen + 0.5
    gain = np.log(toxic / (n[1] + 1)) - np.log(clean / (n[0] + 1))
    return np.maximum(gain - SURE * np.sqrt(1 / toxic + 1 / clean), 0), seen.sum(0)


def fit_filters(w: Words, y: np.ndarray, own: list[np.ndarray] | None = None, chosen: np.ndarray | None = None, seed: int = 3) -> ConvModel:
    """Filters, embeddings and output unit by Adagrad on the logistic loss; words are dropped at random while training.

    The first dimension of an embedding starts from the bucket's own evidence and
    one filter of each width from reading it, the rest from noise.  ``chosen``
    are the texts to learn from.
    """
    rng = np.random.default_rng(seed)
    counts = np.diff(w.offsets)
    own = buckets_of_texts(w) if own is None else own
    chosen = np.arange(len(y)) if chosen is None else chosen
    gain, in_texts = evidence(own, y, chosen)
    known = in_texts >= LEAST_DOCS
    table = (rng.normal(size=(ROWS, DIM)) * 0.05 * known[:, None]).astype(np.float32)
    table[:, 0] = gain * known
    filters = [(rng.normal(size=(k, DIM, FILTERS)) * 0.3).astype(np.float32) for k in WIDTHS]
    out = (rng.normal(size=FILTERS * len(WIDTHS)) * 0.1).astype(np.float32)
    for i, f in enumerate(filters):
        f[:, :, 0] = 0
        f[:, 0, 0] = 1 / len(f)
        out[i * FILTERS] = 2
    m = ConvModel(table, filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], out, -1.0)
    weight = np.where(y == 1, min(4.0, (y[chosen] == 0).sum() / max(1, (y[chosen] == 1).sum())), 1.0)
    parts = [*m.filters, *m.shifts, m.out]
    past, past_bias, past_table = [np.full_like(p, 1e-3) for p in parts], 1e-3, np.full(ROWS, 1e-3, np.float32)
    first = np.cumsum([0, *(FILTERS * k for k in WIDTHS)])
    for _ in range(int(np.clip(-(-STEPS * BATCH // len(chosen)), *EPOCHS))):
        rows_of = m.embed(w)  # of words whose buckets move through others, as of the start of the round
        for rows in np.array_split(rng.permutation(chosen), max(1, len(chosen) // BATCH)):
            spans = [w.ids[w.begins[r] : w.begins[r + 1]] for r in rows]
            ids = np.concatenate(spans)
            ids = np.where(rng.random(len(ids)) < 0.2, w.n, ids)
            # two more blanks after each text, where no window begins: none sees the next text
            ids = np.insert(ids, np.repeat(np.cumsum([len(s) for s in spans]), 2), w.n)
            begins = np.concatenate([[0], np.cumsum([len(s) + 2 for s in spans])])
            projected = rows_of[ids] @ np.concatenate([f for block in m.filters for f in block], axis=1)
            tops, hidden = [], []
            for i, (k, shift) in enumerate(zip(WIDTHS, m.shifts)):
                cols = [slice(first[i] + j * FILTERS, first[i] + (j + 1) * FILTERS) for j in range(k)]
                got = sum(projected[j : len(ids) - 2 + j, c] for j, c in enumerate(cols))
                top = np.stack([a + got[a : b - 2].argmax(0) for a, b in zip(begins, begins[1:])])
                tops.append(top)
                hidden.append(got[top, np.arange(FILTERS)] + shift)
            h = np.concatenate(hidden, axis=1)
            z = np.maximum(h, 0) @ m.out + m.bias
            d = (weight[rows] * (sigmoid(z) - y[rows]) / len(rows)).astype(np.float32)
            back = d[:, None] * m.out * (h > 0)
            d_filters, words, d_words = [], [], []
            for i, (k, f) in enumerate(zip(WIDTHS, m.filters)):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                grads = []
                for j in range(k):
                    at = ids[tops[i] + j]
                    grads.append(np.einsum("bf,bfd->df", g, rows_of[at]))
                    words.append(at.ravel())
                    d_words.append((g[:, :, None] * f[j].T).reshape(-1, DIM))
                d_filters.append(np.stack(grads) + 1e-5 * f)
            grads = [*d_filters, *[back[:, i * FILTERS : (i + 1) * FILTERS].sum(0) for i in range(len(WIDTHS))], np.maximum(h, 0).T @ d + 1e-4 * m.out]
            for p, g, s in zip(parts, grads, past):
                s += g * g
                p -= RATE * g / np.sqrt(s)
            past_bias += d.sum() ** 2
            m.bias -= float(RATE * d.sum() / np.sqrt(past_bias))
            words, d_words = np.concatenate(words), np.concatenate(d_words)
            use = (words < w.n) & d_words.any(1)
            moved, place = np.unique(words[use], return_inverse=True)
            if not len(moved):
                continue
            d_emb = np.zeros((len(moved), DIM), np.float32)
            np.add.at(d_emb, place, d_words[use])
            n, begin = counts[moved], np.cumsum(counts[moved]) - counts[moved]
            buckets = w.buckets[np.repeat(w.offsets[moved] - begin, n) + np.arange(int(n.sum()))]
            order = np.argsort(buckets, kind="stable")
            at, cut = np.unique(buckets[order], return_index=True)
            g = np.add.reduceat(np.repeat(d_emb / n[:, None], n, axis=0)[order], cut, axis=0) * known[at][:, None]
            past_table[at] += (g * g).mean(1)
            m.table[at] -= 2 * RATE * g / np.sqrt(past_table[at])[:, None]
            rows_of[moved] = np.add.reduceat(m.table[buckets], begin, axis=0) / n[:, None]
    return m


def calibrate(m: ConvModel, z: np.ndarray, languages: np.ndarray, y: np.ndarray) -> None:
    """A logistic curve for all texts, and one for each language that is drawn to it where labels are few."""
    slope, intercept = fit_logistic(z[:, None], y.astype(float), ridge=0.1)
    m.curves[""] = (float(slope), float(intercept))
    for name in FUNCTION_WORDS:
        own = languages == name
        if y[own].sum() >= 5 and (1 - y[own]).sum() >= 5:
            a, b = fit_logistic(z[own][:, None], y[own].astype(float), ridge=0.1)
            trust = y[own].sum() / (y[own].sum() + 20)
            m.curves[name] = (float(trust * a + (1 - trust) * slope), float(trust * b + (1 - trust) * intercept))


def held_out_scores(w: Words, y: np.ndarray, own: list[np.ndarray]) -> np.ndarray:
    """Raw score of each text from filters that were trained on the other ``FOLDS`` - 1 parts of the sample."""
    fold, z = np.arange(len(y)) % FOLDS, np.zeros(len(y))
    for k in range(FOLDS):
        part = np.flatnonzero(fold == k)
        z[part] = fit_filters(w, y, own, np.flatnonzero(fold != k)).raw(w)[part]
    return z


def train(sample: list[tuple[bytes, int]]) -> ConvModel | None:
    """Filters from the whole sample, calibrated on the scores that cross-validation gives its texts."""
    y = np.array([y for _, y in sample], np.int64)
    fold = np.arange(len(y)) % FOLDS
    if any(len(set(y[fold != k])) < 2 for k in range(FOLDS)):
        return None
    w = words_of([d for d, _ in sample])
    own = buckets_of_texts(w)
    z, languages = held_out_scores(w, y, own), np.array(language_of(w))
    model = fit_filters(w, y, own)
    calibrate(model, z, languages, y)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs(doc_id, text)``."""
    model = trained(docs, labels, "toxic", train_rows, train)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"),
    )
    return rows.mapInPandas(_scorer(model, threshold), "doc_id bigint, held_out boolean, score double, predicted int")


def _scores(model: ConvModel | None, texts: list[bytes]) -> np.ndarray:
    """Scores of a batch, some texts at a time."""
    if model is None:
        return np.full(len(texts), 0.5)
    out, held, size = [np.empty(0)], [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size > BATCH_BYTES:
            out.append(model.score(held))
            held, size = [], 0
    return np.concatenate([*out, model.score(held)] if held else out)


def _scorer(model: ConvModel | None, threshold: float):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = _scores(model, list(batch["data"]))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": p, "predicted": (p >= threshold).astype("int32")})

    return work


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below ``threshold``."""
    model = trained(docs, labels, "toxic", train_rows, train)

    @F.pandas_udf("double")
    def score(data: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in data:
            yield pd.Series(_scores(model, list(part)))

    return docs.where(score(F.coalesce(F.col("text"), F.lit("")).cast("binary")) < threshold)
