"""Packing plans on counts, and packed documents against the tokenizers library."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from pulsegrid.llm import best_fit_packing as packing
from pulsegrid.llm.queries import BYTE_BPE


def test_index_counts_sums_of_available_lengths():
    rng = random.Random(1)
    counts = np.array([0] + [rng.choice([0, 0, 1, 2, 5]) for _ in range(40)], np.int64)
    index = packing.ComplementIndex(counts)
    for _ in range(30):
        there = [x for x in range(41) if counts[x]]
        for n, table in ((1, index.single), (2, index.pairs), (3, index.triples)):
            want = Counter(map(sum, itertools.combinations_with_replacement(there, n)))
            assert table.tolist() == [want[s] for s in range(41)]
        if not there:
            break
        index.take(Counter([rng.choice(there)]), 1)


@pytest.mark.parametrize("kind", ["uniform", "short", "long", "same", "few", "none"])
def test_plans_place_every_piece_once_without_gaps(kind):
    rng = np.random.default_rng(2)
    lengths = {
        "uniform": rng.integers(1, 101, 3000), "short": rng.integers(1, 9, 2000), "long": rng.integers(45, 101, 2000),
        "same": np.full(1000, 30), "few": rng.integers(1, 101, 7), "none": np.zeros(0, np.int64),
    }[kind]
    counts = np.bincount(lengths, minlength=101)
    plan = packing.plan_packing(counts)
    seen: Counter = Counter()
    rank = np.array([(seen.update([x]), seen[x] - 1)[1] for x in lengths.tolist()], np.int64)
    sequence, offset = plan.place(lengths, rank) if len(lengths) else (lengths, lengths)
    held = defaultdict(list)
    for s, o, x in zip(sequence.tolist(), offset.tolist(), lengths.tolist()):
        held[s].append((o, x))
    assert len(held) == plan.sequences and int(counts.sum()) == len(lengths)
    for parts in held.values():
        at = 0
        for o, x in sorted(parts):
            assert o == at
            at += x
        assert at <= 100
    least = max(-(-int(lengths.sum()) // 100), int((lengths > 50).sum()))
    least = -(-1000 // 3) if kind == "same" else least  # three of thirty fit
    assert plan.sequences <= 1.01 * least + 1 or kind == "long"
    plain = sum(n for _, n in packing.best_fit_patterns(counts.copy()))
    assert plan.sequences <= plain


def test_exact_complements_come_before_best_fit():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 25, 15, 70]] = [3, 1, 1, 1, 1]
    made = packing.exact_patterns(counts)
    assert made == [(((60, 1), (40, 1)), 1), (((60, 1), (25, 1), (15, 1)), 1)]
    assert counts.nonzero()[0].tolist() == [60, 70]


def documents() -> list[tuple]:
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randint(0, 500)}" for _ in range(rng.choice([0, 1, 5, 40, 200])))) for i in range(120)]
    return [*rows, (3, rows[3][1]), (None, "no id"), (None, "no id"), (500, None), (501, ""), (502, "long text " * 3000), (503, "<|endoftext|> é\n\n 日本")]


@pytest.mark.parametrize("capacity", [64, 1024])
def test_packed_pieces_are_the_librarys_ids(spark, capacity):
    cfg = packing.PackConfig(capacity=capacity, end_id=2)
    rows = documents()
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id bigint, text string, length int, piece string").repartition(5)
    library = Tokenizer.from_file(BYTE_BPE)
    want = Counter()
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    got = packing.pack_documents(docs, BYTE_BPE, cfg).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"], r["ids_crc32"]))
    assert all([o for o, _, _ in sorted(p)] == [0, *np.cumsum([x for _, x, _ in sorted(p)])[:-1].tolist()] for p in held.values())
    total = sum(r["length"] for r in got)
    assert max(sum(x for _, x, _ in p) for p in held.values()) <= capacity and len(held) <= 1.01 * total / capacity + 1

    whole = packing.packed_sequences(docs, BYTE_BPE, cfg).collect()
    assert len(whole) == len(held) and sum(r["n_tokens"] for r in whole) == total
    pieces = Counter()
    for r in whole:
        assert len(r["ids"]) == 4 * r["n_tokens"]
        for p in r["parts"]:
            pieces[(p["doc_id"], p["piece"], p["length"], zlib.crc32(r["ids"][4 * p["offset"] : 4 * (p["offset"] + p["length"])]))] += 1
    assert pieces == Counter((d, p, n, c) for (d, p, _, n, c), k in want.items() for _ in range(k))


def test_packing_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack_documents(docs, BYTE_BPE).collect() == [] and packing.packed_sequences(docs, BYTE_BPE).collect() == []
