"""Oversize labelled texts and rows without an id."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import _labelled, compression_quality, fertility, suffix_dedup, toxicity, word_repeats
from pulsegrid.llm.queries import PIECES


@pytest.mark.parametrize("score, label", [(compression_quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_a_labelled_text_over_the_bound_is_passed_over(spark, monkeypatch, score, label):
    monkeypatch.setattr(_labelled, "TRAIN_BYTES", 200_000)
    rng = random.Random(4)
    words = {0: [f"sentence{k} about rivers" for k in range(40)], 1: [f"grumble{k} scornful$" for k in range(40)]}
    rows = [(i, " ".join(rng.choice(words[i % 2]) for _ in range(25))) for i in range(300)]
    ids = spark.range(300, 2000).where(~_labelled.held_out("id")).orderBy(F.xxhash64("id")).limit(1).first()["id"]
    first = spark.range(300).agg(F.min(F.xxhash64("id"))).first()[0]
    assert spark.range(ids, ids + 1).select(F.xxhash64("id")).first()[0] < first  # the long text heads the sample
    docs = spark.createDataFrame([*rows, (ids, "long text " * 30_000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(ids, 0)], f"doc_id bigint, {label} int")
    got = {r["doc_id"]: r for r in score(docs, labels).collect()}
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] < 300]
    assert len(got) == 301 and sum((r["score"] > 0.5) == bool(r["doc_id"] % 2) for r in held) / len(held) > 0.95


def test_a_null_id_is_no_number(spark):
    """The row without an id comes after the one numbered -1, though both have one text."""
    rng = random.Random(5)
    text = " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(80))
    docs = spark.createDataFrame([(-1, text), (None, text)], "doc_id bigint, text string")
    cut = {r["doc_id"]: r for r in suffix_dedup.remove_later_copies(docs, 100).collect()}
    assert cut[-1]["n_removed"] < len(text) and cut[None]["n_removed"] == len(text) and cut[None]["n_spans"] == 1
    cut = {r["doc_id"]: r["n_removed"] for r in word_repeats.remove_repeated_windows(docs, 35).collect()}
    assert cut == {-1: 80, None: 80}


def test_a_small_size_class_is_judged_by_the_sizes_around_it(spark):
    """Plain text of a size that few others have stays, though entropy grows with the size; junk of that size goes."""
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in ("run", "walk", "sing", "talk", "read") for b in ("er", "ing", "s", "") for c in ("", "ly", "ness")]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    sizes = {0: (30, 300), 1: (120, 60), 2: (260, 10), 3: (500, 60), 4: (2000, 300)}
    rows = [(1000 * k + i, text(n), "en") for k, (n, times) in sizes.items() for i in range(times)]
    rows += [(9000, " ".join(f"zq{rng.randint(0, 9**9)}xjv" for _ in range(260)), "en")]
    got = {r["doc_id"]: r["kept"] for r in fertility.judge_quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), PIECES).collect()}
    assert all(got[2000 + i] for i in range(10)) and not got[9000] and sum(got.values()) >= 0.97 * len(rows)


def test_bands_equal_percentiles_over_the_sizes_they_reach(spark):
    rng = random.Random(9)
    rows = [(i, "en" if i % 3 else "de", "latin", rng.choice([4, 5, 5, 6, 9]), 10, rng.random() * 4, rng.random() / 5, rng.random() * 9) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id bigint, band string, script string, size_class int, n_tokens bigint, chars_per_token double, byte_share double, token_entropy double")
    rules = fertility.FertilityRules(least_class=30)
    values = fertility.histogram(table)
    for level, (column, reach) in enumerate(fertility.LEVELS):
        for r in fertility.bands(values, rules, level).collect():
            at = [x for x in rows if (column is None or x[1 if column == "band" else 2] == r[column]) and (reach is None or abs(x[3] - r["size_class"]) <= reach)]
            assert len(at) >= 30 or column is None
            low, middle, high = np.quantile([round(x[5], 2) for x in at], [0.25, 0.5, 0.75])
            width = 2 * max(high - low, 0.02 * middle)
            limits = r[f"limits_{level}"]
            assert abs(limits["chars_per_token_low"] - (low - width)) < 1e-9 and abs(limits["chars_per_token_high"] - (high + width)) < 1e-9
