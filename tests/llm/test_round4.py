"""What the findings of round 3 were about."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from pulsegrid.llm import mixing, queries


def _exchanged(df) -> list[set[str]]:
    """The columns, and the fields of structs, that each exchange of the plan sends."""
    plan, found = df._jdf.queryExecution().executedPlan(), []
    stack = [plan.initialPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan]
    while stack:
        node = stack.pop()
        if node.nodeName() == "Exchange":
            columns = [node.output().apply(i) for i in range(node.output().size())]
            found.append({x for c in columns for x in (c.name(), *re.findall(r"(\w+):", c.dataType().simpleString()))})
        stack += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_texts_do_not_travel_where_they_are_not_asked_for(spark, tmp_path):
    rows = [(i, f"src{i % 3}", "word " * 300 + str(i)) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sent = _exchanged(queries.op1_source_mixing(spark, str(tmp_path)))
    assert len(sent) > 2 and not any("text" in columns for columns in sent)


def test_rows_that_share_a_digest_are_ordered_by_text_without_carrying_it(spark):
    """Equal ids with different texts, full copies, null ids, texts and sources: as with the texts carried, and as by plain sorting."""
    rows = [(i % 7 if i % 5 else None, f"s{i % 2}" if i % 11 else None, None if i % 13 == 0 else "é" * (i % 3) + "t" + str(i * 37 % 23)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    cfg = mixing.MixConfig({"s0": 2}, block_rows=3)
    bare = mixing.schedule(docs, cfg, carried=["doc_id"])
    assert bare.columns == ["doc_id", "mix"]
    whole = mixing.schedule(docs, cfg)
    got, full = ({tuple(r) for r in df.select(*(c for c in df.columns if c == "doc_id"), "mix.source", "mix.row", "mix.slot", "mix.position").collect()} for df in (bare, whole))
    assert got == full and len(got) == 400
    key = [(s or "", hashlib.md5((str(d) if d is not None else t or "").encode()).hexdigest(), (t or "").encode(), d) for d, s, t in rows]
    want = {s: [d for x, _, _, d in sorted(key, key=lambda k: k[:3]) if x == s] for s in ("", "s0", "s1")}
    mine = sorted((r["source"], r["row"], r["doc_id"]) for r in bare.select("doc_id", "mix.*").collect())
    for s in want:
        assert [d for x, _, d in mine if x == s] == want[s]
    tied = mixing._text_ranks(docs.select(F.coalesce("source", F.lit("")).alias("source"), F.md5(F.coalesce(F.col("doc_id").cast("string"), "text", F.lit("")).cast("binary")).alias("digest"), F.coalesce("text", F.lit("")).alias("text")).withColumn("text_md5", F.md5(F.col("text").cast("binary"))))
    assert tied.count() > 20


def test_stages_and_rounds_begin_when_the_driver_has_given_up_the_jobs_before(spark, monkeypatch):
    import corpus_pipeline
    from pulsegrid.llm import components

    released = []
    monkeypatch.setattr(corpus_pipeline, "release_shuffles", lambda s: released.append("stage"))
    monkeypatch.setattr(components, "release_shuffles", lambda s: released.append("round"))
    docs = spark.createDataFrame([(1, "en", "src0", "one two")], "doc_id long, lang string, source string, text string")
    assert dict(corpus_pipeline.STAGES)["mixing"](spark, docs, "").count() == 1 and released == ["stage"]
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long")
    assert {r["label"] for r in components.component_labels(chain).collect()} == {0} and released.count("round") > 1
