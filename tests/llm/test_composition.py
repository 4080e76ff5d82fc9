"""The pipeline against brute force over all its stages, and cases that the operators' own tests leave out."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pulsegrid.llm import near_dedup, token_files, vector_search
from pulsegrid.llm.queries import BYTE_BPE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str, k: int) -> set:
    w = WORD.findall((text or "").lower())
    k = min(k, len(w))
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()


def components(sets: dict, percent: int) -> dict:
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in sets}


def cut_copies(rows: list[tuple], width: int = 100) -> dict[int, str]:
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        own = []
        for k in range(len(data) - width + 1):
            piece = data[k : k + width]
            if piece in seen:
                gone[k : k + width] = True
            seen.add(piece)
            own.append(piece)
        out[i] = np.frombuffer(data, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
    return out


def test_pipeline_equals_brute_force_over_all_stages(spark, tmp_path):
    """Toxic documents, near copies, shared passages and several sources together; both labels occur."""
    rng = random.Random(12)
    plain = [f"word{k}" for k in range(500)]
    toxic = [f"scorn{k}" for k in range(6)]
    passage = " ".join(rng.choice(plain) for _ in range(40))
    rows, bad = [], set()
    for i in range(260):
        words = [rng.choice(plain) for _ in range(rng.randint(30, 70))]
        if i % 5 == 2:
            bad.add(i)
            for _ in range(12):
                words[rng.randrange(len(words))] = rng.choice(toxic)
        if i % 9 == 4:
            words = words[:15] + passage.split() + words[15:]
        rows.append((i, " ".join(words), "en", ("src0", "src1", None)[i % 3], 0))
    for i in range(260, 300):
        words = rows[rng.randrange(260)][1].split()
        rows.append((i, " ".join(words + ["tail"] * (i % 2)), "en", "src1", 0))
        if any(w in toxic for w in words):
            bad.add(i)
    rows += [(400, "", "en", "src0", 0), (401, None, "en", "src2", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i in bad)) for i in range(300) if rng.random() < 0.8]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    kept = {i: t or "" for i, t, *_ in rows if i not in bad}
    root = components({i: shingles(t, 5) for i, t in kept.items()}, 80)
    kept = {i: t for i, t in kept.items() if root[i] == i}
    kept = cut_copies(list(kept.items()))
    source = {i: s or "" for i, _, _, s, _ in rows}
    queues: dict[str, list] = {}
    for i in kept:
        queues.setdefault(source[i], []).append(i)
    weights = {s: {"src0": 6, "src1": 4, "src2": 3, "src3": 2}.get(s, 1) for s in queues}
    for q in queues.values():
        q.sort(key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    order, done, slot, total = [], dict.fromkeys(queues, 0), 0, sum(weights.values())
    while len(order) < len(kept):
        released = [(-(-(done[s] + 1) * total // w), s) for s, w in weights.items() if done[s] * total // w <= slot]
        if released:
            s = min(released)[1]
            order += queues[s][8 * done[s] : 8 * done[s] + 8]
            done[s] += 1
        slot += 1
    got = sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: r["position"])
    assert [r["doc_id"] for r in got] == order and [r["position"] for r in got] == list(range(len(order)))
    assert all((r["decoded"] or "") == kept[r["doc_id"]] for r in got)


@pytest.mark.parametrize("deal", [3, 2000])
def test_chains_of_near_copies_and_odd_ids(spark, monkeypatch, deal):
    """A cluster whose members are near a centre but not near each other, and one whose links are just below and above."""
    monkeypatch.setattr(near_dedup, "MEMBERS_PER_TASK_GROUP", deal)
    rng = random.Random(13)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(60):  # every text changes other words of one base: some pairs are linked, some aren't
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 3, 3, 4])):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(words)))
    chain = [f"c{k}" for k in range(300)]
    rows += [(200 + i, " ".join(chain[3 * i : 3 * i + 100])) for i in range(40)]  # each linked with its neighbours alone
    rows += [(300, rows[0][1]), (301, rows[70][1].upper()), (-5, rows[3][1])]
    rng.shuffle(rows)
    sets = {i: shingles(t, 3) for i, t in rows}
    root = components(sets, 85)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, component_id int, keys string").repartition(6)
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(table, near_dedup.NearDupConfig(shingle=3, percent=85)).collect()}
    assert len(set(root.values())) > 2 and {i: r["component_id"] for i, r in got.items()} == root
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (root[i] == i) for i, r in got.items())


def test_shards_roll_and_odd_rows_come_back(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(token_files, "MAX_SHARD_TOKENS", 500)
    rng = random.Random(14)
    rows = [(i // 2, " ".join(f"t{rng.randrange(300)}" for _ in range(rng.choice([0, 3, 90])))) for i in range(80)]
    rows += [(None, "first without an id"), (None, None), (7, "a very long text " * 1800), (rows[4][0], rows[4][1])]
    table = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, n_tokens int").repartition(3)
    manifest, folder = token_files.write_token_files(table, BYTE_BPE, f"file://{tmp_path}/out")
    assert manifest.count() > 5 and manifest.agg({"n_tokens": "sum"}).first()[0] > 9_000
    library = Tokenizer.from_file(BYTE_BPE)
    ids = {t: [*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for doc_id, text in ordered:
        want.append((doc_id, start, len(ids[text]), zlib.crc32(np.array(ids[text], "<u4").tobytes())))
        start += len(ids[text])
    got = sorted(map(tuple, token_files.read_token_files(manifest, folder).collect()), key=lambda r: r[1])
    assert got == want
    file = max((p.read_bytes() for p in (tmp_path / "out").glob("*.pfor")), key=len)
    _, _, whole = token_files.read_shard(file)
    assert len(whole) > token_files.BLOCK
    for a, b in ((0, len(whole)), (4000, len(whole)), (4096, 4097), (17, 18), (5, 5)):
        assert token_files.read_range(file, a, b).tolist() == whole[a:b].tolist()


def test_a_clustered_table_is_searched_in_part(spark, monkeypatch, tmp_path):
    """50,000 vectors in 100 clusters: recall of 0.9 or more from at most a third of the rows."""
    rng = np.random.default_rng(15)
    middles = rng.normal(size=(100, 32))
    x = middles[rng.integers(0, 100, 50_000)] + rng.normal(scale=0.4, size=(50_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    probed: list = []
    train = vector_search.train

    def spied(sample, rows, cfg):
        router, probes = train(sample, rows, cfg)
        probed.append(probes / len(router.b2))
        return router, probes

    monkeypatch.setattr(vector_search, "train", spied)
    pq.write_table(pa.table({"vec_id": np.arange(50_000), "embedding": pa.FixedSizeListArray.from_arrays(x.ravel(), 32).cast(pa.list_(pa.float64()))}), tmp_path / "v.parquet")
    table = spark.read.parquet(str(tmp_path / "v.parquet")).repartition(8)
    got: dict[int, list] = {}
    for r in vector_search.nearest(table, F.pmod("id", F.lit(100)) == 0).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    found = 0
    for q in range(0, 50_000, 100):
        s = x @ x[q]
        s[q] = -np.inf
        found += len(set(np.argpartition(-s, 20)[:20].tolist()) & set(got[q]))
    assert len(got) == 500 and found / (20 * 500) >= 0.9 and probed[0] <= 1 / 3
