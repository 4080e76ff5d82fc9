"""Corpus operators against brute force on small fixtures, with nulls, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulsegrid.llm import fertility, mixing, near_dedup, sentence_pieces, suffix_dedup, token_files, toxicity, vector_search, word_repeats
from pulsegrid.llm.piece_lattice import PieceLattice, segments
from pulsegrid.llm.queries import BYTE_BPE, PIECES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["é", "日本", "ß🙂"]
    shared = " ".join(rng.choice(words) for _ in range(60))
    rows = []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        if i % 5 == 0:
            body = body[:30] + shared.split() + body[30:]
        rows.append((i, " ".join(body), "src0" if i % 3 else None, "x", i))
    for i in range(n, n + 8):  # near and exact copies
        base = rows[i - n + 1][1].split()
        rows.append((i, " ".join(base if i % 2 else base + ["tail"]), "src1", "x", i))
    return [*rows, (n + 20, None, "src2", "x", 0), (n + 21, "", "src2", "x", 0), (n + 22, "one two", None, "x", 0), (n + 23, "  \n ", "src2", "x", 0)]


SCHEMA = "doc_id bigint, text string, source string, position string, mix bigint"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_word_windows_equal_brute_force(docs, empty):
    width, seen = 35, {}
    words = {r[0]: WORD.findall(r[1] or "") for r in corpus()}
    for i, w in words.items():
        for k in range(len(w) - width + 1):
            seen.setdefault(tuple(w[k : k + width]), []).append((i, k))
    gone = {i: set() for i in words}
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                gone[i].update(range(k, k + width))
    got = by_id(word_repeats.remove_repeated_windows(docs, width))
    for i, w in words.items():
        kept = " ".join(x for k, x in enumerate(w) if k not in gone[i])
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), len(gone[i]), hashlib.sha256(kept.encode()).hexdigest())
    assert word_repeats.remove_repeated_windows(empty, width).count() == 0


def test_byte_copies_equal_brute_force(docs, empty):
    width, seen, gone = 100, set(), {}
    for i, text, *_ in sorted(corpus()):
        data = (text or "").encode()
        gone[i] = np.zeros(len(data), bool)
        for k in range(len(data) - width + 1):
            s = data[k : k + width]
            if s in seen:
                gone[i][k : k + width] = True
            seen.add(s)
    got = by_id(suffix_dedup.remove_later_copies(docs, width))
    for i, text, *_ in corpus():
        data = np.frombuffer((text or "").encode(), np.uint8)
        spans = int((np.diff(gone[i].astype(int), prepend=0) == 1).sum())
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"]) == (len(data), int(gone[i].sum()), spans)
        assert got[i]["kept_sha256"] == hashlib.sha256(data[~gone[i]].tobytes()).hexdigest()
    cut = by_id(suffix_dedup.without_later_copies(docs, width))
    assert len(cut) == len(corpus()) and set(cut[0].asDict()) == set(docs.columns)
    assert suffix_dedup.remove_later_copies(empty, width).count() == 0


def test_near_duplicates_equal_brute_force(docs, empty):
    cfg = near_dedup.NearDupConfig(shingle=3, percent=85)
    sets = {}
    for i, text, *_ in corpus():
        w = WORD.findall((text or "").lower())
        k = min(3, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = by_id(near_dedup.near_duplicates(docs, cfg))
    for i in sets:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), root(i), root(i) == i)
    assert near_dedup.near_duplicates(empty, cfg).count() == 0
    assert near_dedup.without_near_duplicates(docs, cfg).count() == sum(root(i) == i for i in sets)


def test_base_counts_equal_brute_force(docs, empty):
    got = by_id(fertility.judge_quality(docs, PIECES))
    for i, text, *_ in corpus():
        w = WORD.findall(text or "")
        at = {}
        for k in range(len(w) - 4):
            at.setdefault(tuple(w[k : k + 5]), []).append(k)
        again = {x for v in at.values() if len(v) > 1 for k in v for x in range(k, k + 5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 10 or 100 * len(again) > 20 * len(w))
    assert fertility.judge_quality(empty, PIECES).count() == 0


def test_mixture_keeps_shares_and_rows(docs, empty):
    cfg = mixing.MixConfig({"src0": 2}, block_rows=2)
    rows = mixing.schedule(docs, cfg).select("doc_id", "mix_.*").collect()
    assert sorted(r["position"] for r in rows) == list(range(len(corpus())))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    assert mixing.mixed(docs, cfg, 2).count() == len(corpus()) and mixing.mixed(docs, cfg, 2).columns == docs.columns
    assert mixing.schedule(empty, cfg).count() == 0


def test_n_best_is_exact_and_decodes(docs, empty):
    lattice = PieceLattice(PIECES)

    def every(data: bytes):
        if not data:
            return [(0.0, ())]
        return [(s + x, (*ids, i)) for start, i, x in lattice.edges_to_all(data) for s, ids in every(data[:start])]

    lattice.edges_to_all = lambda data: lattice.edges_to(data, len(data))
    for word in ("cat", " the", "a日b", " ab▁"):
        want = sorted((-s for s, _ in every(word.encode())))[:6]
        assert np.allclose(want, [-s for s, _ in lattice.n_best(word, 6)])
    for text in ("Hello there, world\n  two  spaces ▁ 日本🙂", "", " ", "x" * 300):
        for ids in lattice.encode([text], 4)[0][0]:
            assert lattice.decode(np.frombuffer(ids, "<u4")) == text
    assert "".join(segments("a  b\nc")) == " a  b\nc"
    got = by_id(sentence_pieces.piece_table(docs, PIECES))
    assert all(r["round_trip"] for r in got.values()) and len(got) == len(corpus())
    coded = sentence_pieces.encode(docs, PIECES, 2)
    back = sentence_pieces.decode(coded.withColumn("ids", F.col("segmentations")[0]["ids"]), PIECES, out_col="again")
    assert all((r["text"] or "") == r["again"] for r in back.collect())
    assert sentence_pieces.piece_table(empty, PIECES).count() == 0


def test_token_files_round_trip(docs, empty):
    from tokenizers import Tokenizer

    path = BYTE_BPE
    t, start = Tokenizer.from_file(path), 0
    got = by_id(token_files.token_file_table(docs, path))
    for i, text, *_ in sorted(corpus()):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.token_file_table(empty, path).count() == 0
    odd = np.array([7, 7, 4_000_000_000, 7, 0], np.uint32)
    assert (token_files.unpack_block(memoryview(token_files.pack_block(odd)), 0) == odd).all()


def test_nearest_vectors_recall(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (0, x[0].tolist())]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = vector_search.nearest(table, F.pmod("id", F.lit(20)) == 0).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, 1500, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert set(found) == set(range(0, 1500, 20)) and hits / (75 * 20) >= 0.9


def test_toxicity_learns_planted_words(spark, empty):
    rng = random.Random(2)
    plain = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(40)] = "awfulinsult"
        rows.append((i, " ".join(words), None, "x", 0))
        labels.append((i, 1, int(bad)))
    labels += [(None, 1, 1), (3, None, None)]
    table = spark.createDataFrame([*rows, (10_000, None, None, "x", 0), (None, "", None, "x", 0)], SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = by_id(toxicity.score_toxicity(table, marks))
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum(got[i]["predicted"] == int(i % 4 == 0) for i in held)
    assert right / len(held) > 0.95 and all(got[i]["held_out"] for i in held)
    assert got[10_000]["predicted"] == 0 and 0 <= got[None]["score"] <= 1
    kept = toxicity.without_toxic(table, marks)
    assert kept.columns == table.columns and kept.where("doc_id is null").count() == 1
    assert toxicity.score_toxicity(empty, marks).count() == 0


def test_pipeline_stages_take_effect(spark, tmp_path):
    rows = [(i, t, s, "en", len(t or "")) for i, t, s, *_ in corpus()]
    rows = [(i, t, "en", s, n) for i, t, s, _, n in rows]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert 0 < got.count() < len(rows)
    assert got.where("n_pieces is null").count() == 0


def test_mixture_reaches_the_last_stage(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        text = " ".join(f"v{rng.randrange(9000)}" for _ in range(400 if i % 7 == 0 else 12))
        rows.append((i, text, "en", ("src0", "src1", None, "other")[(i * i) % 4], len(text)))
    rows.append((500, "  two  words\n", "en", "src2", 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    stages = dict(corpus_pipeline.STAGES)
    stages["mixing"](spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/mixed.parquet")
    got = stages["sentence_pieces"](spark, spark.read.parquet(f"{tmp_path}/mixed.parquet"), str(tmp_path)).collect()

    queues: dict[str, list] = {}
    for i, _, _, source, _ in rows:
        queues.setdefault(source or "", []).append(i)
    weights, order, done = {s: {"src0": 6, "src1": 4, "src2": 3, "src3": 2}.get(s, 1) for s in queues}, [], dict.fromkeys(queues, 0)
    total = sum(weights.values())
    for q in queues.values():
        q.sort(key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    slot = 0
    while len(order) < len(rows):
        released = [(-(-(done[s] + 1) * total // w), s) for s, w in weights.items() if done[s] * total // w <= slot]
        if released:
            s = min(released)[1]
            order += queues[s][8 * done[s] : 8 * done[s] + 8]
            done[s] += 1
        slot += 1
    assert [r["doc_id"] for r in got] == order
    assert [r["position"] for r in got] == list(range(len(rows)))
    texts = {r[0]: r[1] for r in rows}
    assert all(r["decoded"] == texts[r["doc_id"]] for r in got)


def test_added_tokens_are_encoded_as_by_the_library(spark):
    from tokenizers import Tokenizer

    path = BYTE_BPE
    t, start = Tokenizer.from_file(path), 0
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>\n  <|endoftext|>y", "<|endoftext", "plain text"]
    got = by_id(token_files.token_file_table(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), path))
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_small_classes_are_judged_by_a_wider_band(spark):
    rng = random.Random(4)
    words = "time house water people great little world under never think small place right after light found story river paper green".split()

    def prose(n: int) -> str:
        return " ".join(rng.choice(words) for _ in range(n))

    def junk(n: int) -> str:
        return " ".join("".join(rng.choice("\u16a0\u16a1\u16a2\u16a3\u16a4\u16a5\u16a6\u16a7") for _ in range(6)) for _ in range(n))

    rows = [(i, prose(40 + i % 15), "en") for i in range(40)]
    rows += [(100, junk(900), "en"), (101, prose(20) + " " + junk(300), "xx"), (102, junk(800), None)]
    got = by_id(fertility.judge_quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), PIECES))
    assert not any(got[i]["base_failed"] or got[i]["kept"] for i in (100, 101, 102))
    assert sum(got[i]["kept"] for i in range(40)) >= 36
    few = by_id(fertility.judge_quality(spark.createDataFrame([*rows[:12], rows[40]], "doc_id bigint, text string, lang string"), PIECES))
    assert not few[100]["kept"] and sum(few[i]["kept"] for i in range(12)) >= 10


def test_long_runs_without_a_space(spark):
    import resource

    lattice = PieceLattice(PIECES)
    rng = random.Random(6)
    for _ in range(60):  # all segmentations with their scores, ranked by score and by ids from the end
        data = "".join(rng.choice("aabn日") for _ in range(rng.randint(1, 9))).encode()
        ahead, heads = lattice.forward(data), [(0.0, (), len(data))]
        every = []
        while heads:
            behind, ids, at = heads.pop()
            if at:
                heads += [(behind + x, (*ids, i), start) for start, i, x in lattice.edges_to(data, at) if ahead[start] > -np.inf]
            else:
                every.append((-behind, ids))
        want, got = sorted(every)[:4], lattice.n_best(data.decode(), 4)
        assert len(got) == len(want) and np.allclose([-s for s, _ in want], [s for s, _ in got])
        for s, ids in got:
            assert any(np.array(i[::-1], "<u4").tobytes() == ids and abs(x + s) < 1e-9 for x, i in every)
    text = "".join(rng.choice("的一是不了人我在有他这为之大来以个中上们abc0189+/") for _ in range(400_000))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    (ids, scores, _), = lattice.encode([text], 4)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600_000
    assert len(text.encode()) > 900_000 and len(set(ids)) == 4 and scores == sorted(scores, reverse=True)
    assert all(lattice.decode(np.frombuffer(i, "<u4")) == text for i in ids)
    row = sentence_pieces.piece_table(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), PIECES).collect()[0]
    assert row["round_trip"] and row["ids_crc32"] == zlib.crc32(ids[0])


def test_toxicity_of_a_text_is_its_own():
    rng = np.random.default_rng(1)
    width = toxicity.DIM, toxicity.FILTERS
    model = toxicity.ConvModel(
        rng.normal(size=(toxicity.ROWS, width[0])).astype(np.float32),
        [rng.normal(size=(k, *width)).astype(np.float32) for k in toxicity.WIDTHS],
        [np.zeros(width[1], np.float32) for _ in toxicity.WIDTHS],
        rng.normal(size=width[1] * len(toxicity.WIDTHS)).astype(np.float32),
        0.0,
        {"": (1.0, 0.0)},
    )
    texts = [b"", b"clean words here", b"awful insult first", b"one", b"", b"  ", b"the last of them"]
    alone = np.array([float(model.raw(toxicity.words_of([t]))[0]) for t in texts])
    for order in (range(7), [2, 1, 0, 3, 6, 5, 4], [6, 0, 6, 3, 2, 4, 2]):
        together = model.raw(toxicity.words_of([texts[k] for k in order]))
        assert np.allclose(together, alone[list(order)], atol=1e-4)


def test_toxicity_training_keeps_texts_apart():
    texts = [b"plain words only"] * 40 + [b"insult comes here"] * 40
    y = np.array([0] * 40 + [1] * 40)
    w = toxicity.words_of(texts)
    m = toxicity.fit_filters(w, y)
    z = m.raw(w)
    assert z[:40].max() < 0 < z[40:].min()
    empty = toxicity.fit_filters(toxicity.words_of([b"", b"insult here"] * 40), np.array([0, 1] * 40))
    assert empty.raw(toxicity.words_of([b""]))[0] < 0 < empty.raw(toxicity.words_of([b"insult here"]))[0]
