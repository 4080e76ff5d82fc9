"""Window search with split buckets, longest previous factors, quality classifier, long cycles of the mixture."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import _repeats, compression_quality, mixing, suffix_dedup, word_repeats


def test_longest_previous_factors_equal_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        data = bytes(rng.choice(b"ab\x00c") for _ in range(rng.randint(1, 120)))
        positions = np.arange(len(data))
        got = suffix_dedup.longest_previous_factors(np.frombuffer(data, np.uint8), positions, len(data) - positions)
        for p in range(len(data)):
            want = max((next((x for x in range(len(data) - p) if data[p + x] != data[q + x]), len(data) - p) for q in range(p)), default=0)
            assert got[p] == want


def hot_rows() -> list[tuple]:
    """A passage in many different contexts, exact copies, a repeated row and a null id."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = " ".join(word() for _ in range(50))
    rows = [(i, " ".join([word() for _ in range(20)] + [passage] + [word() for _ in range(20)])) for i in range(30)]
    return [*rows, (40, rows[3][1]), (40, rows[3][1]), (41, None), (None, rows[5][1])]


@pytest.mark.parametrize("group", [3, 2500])
def test_split_buckets_give_the_same_rows(spark, monkeypatch, group):
    monkeypatch.setattr(_repeats, "GROUP", group)
    rows = hot_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))  # equal rows are one document
    seen, removed = set(), {}
    for i, text in order:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            if data[k : k + 100] in seen:
                gone[k : k + 100] = True
            seen.add(data[k : k + 100])
        removed[i] = int(gone.sum())
    got = suffix_dedup.remove_later_copies(docs, 100).collect()
    assert len(got) == len(rows) and all(r["n_removed"] == removed[r["doc_id"]] for r in got)

    count: dict[tuple, int] = {}
    for _, text in rows:
        w = (text or "").split()
        for k in range(len(w) - 34):
            count[tuple(w[k : k + 35])] = count.get(tuple(w[k : k + 35]), 0) + 1
    want = {}
    for i, text in rows:
        w, gone = (text or "").split(), set()
        for k in range(len(w) - 34):
            if count[tuple(w[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        want[i] = len(gone)
    got = word_repeats.remove_repeated_windows(docs, 35).collect()
    assert len(got) == len(rows) and all(r["n_removed"] == want[r["doc_id"]] for r in got)


def test_quality_learns_and_handles_odd_rows(spark):
    rng = random.Random(2)
    good = [f"sentence{k} about rivers" for k in range(40)]
    bad = [f"$$ buy{k} now ###" for k in range(40)]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad) for _ in range(30)), "x") for i in range(600)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(600)] + [(None, 1, 0), (5000, None, None)]
    odd = [(9000, None, "x"), (9001, "", "x"), (None, rows[1][1], "x"), (9002, rows[1][1] * 400, "x"), (1, rows[1][1], "x")]
    table = spark.createDataFrame([*rows, *odd], "doc_id bigint, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = compression_quality.score_quality(table, marks).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in held)
    assert sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held) / len(held) > 0.95
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[9000] == scores[9001] and scores[None] == scores[1] and not [r for r in got if r["doc_id"] is None][0]["held_out"]
    assert compression_quality.score_quality(table.limit(0), marks).count() == 0
    assert {r["score"] for r in compression_quality.score_quality(table, marks.where("quality = 1")).collect()} == {0.5}


@pytest.mark.parametrize("bits", [1 << 27, 0])
def test_mixture_of_many_sources_stays_within_one_block(spark, monkeypatch, bits):
    monkeypatch.setattr(mixing, "BROADCAST_BITS", bits)
    sources = 65  # more than one word of bits
    cfg = mixing.MixConfig({f"s{k}": 2 + 2 * (k % 7) for k in range(sources)}, 2, 1)
    docs = spark.range(6500).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % sources).alias("source"), F.lit("t").alias("text"))
    rows = mixing.schedule(docs, cfg).select("mix.*").collect()
    assert sorted(r["position"] for r in rows) == list(range(6500))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    total = sum(1 + k % 7 for k in range(sources))
    done: dict[str, int] = {}
    first = sorted((r["slot"], r["source"]) for r in rows)[:total]
    assert [s for s, _ in first] == list(range(total))
    for t, (_, source) in enumerate(first, 1):
        done[source] = done.get(source, 0) + 1
        assert abs(done[source] - t * (1 + int(source[1:]) % 7) / total) < 1
