"""Product codes and Yinyang clusters against plain integer arithmetic, and what they send and measure."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from pulsegrid.llm import _vectors, centroids, vector_codes

ODD = [None, [None] * 8, [1.0] * 7 + [math.nan], [math.inf] + [0.0] * 7, [-math.inf] * 8, [1.0] * 4, [], [1.0] * 9]


def rows_of(n: int, seed: int, dims: int = 8) -> list[tuple]:
    """Clustered vectors; some repeat, some lack an id or a label."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        middle = rng.randint(-3, 3)
        out.append((i * 3 - 20, [middle / 4 + rng.gauss(0, 0.2) for _ in range(dims)], i % 3 or None))
    out += [(out[0][0], out[5 % n][1], 1), out[7 % n], (None, out[9 % n][1], 2), (None, [1e30] * dims, None), (n * 3, [0.0] * dims, 1)]
    return out


def table(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "1 as v", "'x' as codes", "2 as cluster", "0 as part").repartition(partitions)


def floors(v, scale):
    return [max(-(2**27), min(2**27, math.floor(scale * x))) for x in v]


def plain_codes(rows, cfg):
    kept = sorted(((i, floors(v, cfg.scale), label) for i, v, label in rows if v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = 8 // cfg.parts
    cut = lambda v: [tuple(v[p * w : p * w + w]) for p in range(cfg.parts)]
    books = [[cut(v)[p] for _, v, _ in kept[: cfg.entries]] for p in range(cfg.parts)]
    near = lambda book, x: min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))
    for _ in range(cfg.rounds):
        for p in range(cfg.parts):
            members: dict[int, list] = {}
            for _, v, _ in kept:
                members.setdefault(near(books[p], cut(v)[p])[1], []).append(cut(v)[p])
            for k, xs in members.items():
                books[p][k] = tuple(sum(c) // len(xs) for c in zip(*xs))
    coded = []
    for i, v, label in kept:
        found = [near(books[p], x) for p, x in enumerate(cut(v))]
        coded.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    by_label: dict = {}
    for _, _, e, label in coded:
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label], digest) for i, c, e, label in coded), key=repr)


@pytest.mark.parametrize("n, entries", [(150, 12), (5, 256)])
def test_codes_equal_plain_rounds(spark, n, entries):
    cfg = vector_codes.CodeConfig(parts=4, entries=entries, rounds=4, scale=1024)
    rows = rows_of(n, seed=n) + [(900 + k, v, 1) for k, v in enumerate(ODD)]
    got = vector_codes.code_table(table(spark, rows), cfg)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_codes(rows, cfg)


def test_codes_of_odd_tables(spark):
    assert vector_codes.code_table(table(spark, []).limit(0)).collect() == []
    assert vector_codes.code_table(table(spark, [(k, v, 1) for k, v in enumerate(ODD) if not v or len(v) != 4])).collect() == []
    one = vector_codes.code_table(table(spark, [(4, [0.5] * 4, None)]).drop("label")).collect()
    assert [tuple(r)[:4] for r in one] == [(4, "00000000", 0, 0)]


def test_only_changed_parts_are_sent_on(spark):
    rows = vector_codes.integer_vectors(table(spark, rows_of(200, 3)), cfg := vector_codes.CodeConfig(entries=10), "vec_id", "embedding", "label")
    rows = vector_codes.materialise(rows, "test")
    books, state = vector_codes.train_codebooks(rows, cfg)
    moved = state.where("was != codes").count()
    assert 0 < moved < 0.5 * state.count()
    whole = vector_codes._contributions(state.withColumn("was", vector_codes.F.lit(None).cast("array<smallint>")), 4, 2).collect()
    for r in whole:  # the running sums are those of all parts
        assert books.counts[r["part"], r["entry"]] == r["count"] and books.sums[r["part"], r["entry"]].tolist() == list(r[3:])
    assert books.counts.sum() == 4 * state.count()
    near = vector_codes.decode(vector_codes.encode(rows, books), books, cfg).collect()
    assert len(near) == state.count() and all(len(r["approximate"]) == 8 for r in near)


def test_large_integers_are_exact():
    rng = np.random.default_rng(1)
    for most in (5, 1 << 20, 1 << 27):
        x, c = rng.integers(-most, most + 1, (20, 9)), rng.integers(-most, most + 1, (7, 9))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, p)) for p in c] for r in x]
        assert _vectors.squared_distances(x, c).tolist() == want


def plain_clusters(rows, cfg):
    kept = [(i, floors(v, cfg.scale)) for i, v, _ in rows if v is not None and len(v) == cfg.dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{cfg.seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    middles = [tuple(v) for _, v in sorted(kept, key=key)[: cfg.clusters]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(middles))
    for _ in range(cfg.rounds):
        members: dict[int, list] = {}
        for _, v in kept:
            members.setdefault(near(v)[1], []).append(v)
        for k, xs in members.items():
            middles[k] = tuple(sum(c) // len(xs) for c in zip(*xs))
    found = [(i, *reversed(near(v))) for i, v in kept]
    inertia: dict[int, int] = {}
    for _, k, d in found:
        inertia[k] = inertia.get(k, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middles]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), digest[k]) for i, k, d in found), key=repr)


@pytest.mark.parametrize("n, clusters", [(160, 16), (160, 5), (6, 16)])
def test_clusters_equal_plain_rounds(spark, n, clusters):
    cfg = centroids.ClusterConfig(clusters=clusters, rounds=3, dims=8, scale=16)
    rows = rows_of(n, seed=n + clusters) + [(900 + k, v, 1) for k, v in enumerate(ODD)]
    got = centroids.cluster_table(table(spark, rows), cfg)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_clusters(rows, cfg)


def test_clusters_of_odd_tables(spark):
    cfg = centroids.ClusterConfig(dims=8)
    assert centroids.cluster_table(table(spark, []).limit(0), cfg).collect() == []
    assert centroids.cluster_table(table(spark, [(k, v, 1) for k, v in enumerate(ODD)]), cfg).collect() == []
    same = centroids.cluster_table(table(spark, [(k, [0.25] * 8, 1) for k in range(40)]), cfg).collect()
    assert {tuple(r)[1:5] for r in same} == {(0, 0, 0, 0)} and len(same) == 40


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_bounds_hold_and_spare_distances(spread):
    rng = np.random.default_rng(7)
    middles = rng.integers(-400, 400, (24, 16))
    x = middles[rng.integers(0, 24, 4000)] + np.floor(rng.normal(0, 400 * spread, (4000, 16))).astype(np.int64)
    c = x[:24].copy()
    groups = centroids.group_centroids(c, 6)
    now, measured = centroids.measure_all(x, c, groups), 0
    for _ in range(5):
        new = np.stack([x[now.cluster == k].sum(0) // max(1, (now.cluster == k).sum()) if (now.cluster == k).any() else c[k] for k in range(24)])
        moved = np.sqrt(((new - c) ** 2).sum(1).astype(float))
        c = new
        now, n = centroids.measure_near(x, now, c, groups, moved)
        measured += n
        d = _vectors.squared_distances(x, c)
        assert (now.cluster == d.argmin(1)).all()
        far = np.sqrt(d.astype(float))
        assert (now.upper * (1 + 1e-9) >= far[np.arange(len(x)), now.cluster]).all()
        far[np.arange(len(x)), now.cluster] = np.inf
        assert all((now.lower[:, g] * (1 - 1e-9) <= far[:, groups == g].min(1)).all() for g in range(groups.max() + 1))
    assert measured < (0.25 if spread < 0.1 else 0.9) * 5 * len(x) * 24
