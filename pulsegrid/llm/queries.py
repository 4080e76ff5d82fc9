"""Registered queries of the corpus operators; each applies one operator to its whole table."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    best_fit_packing,
    centroids,
    compression_quality,
    fertility,
    mixing,
    near_dedup,
    sentence_pieces,
    suffix_dedup,
    token_files,
    toxicity,
    vector_codes,
    vector_search,
    vector_sql,
    word_repeats,
)
from ._shared import read_table


def tokenizer_file(name: str) -> str:
    """A public vocabulary file, from the folder ``PULSEGRID_TOKENIZERS`` where that is set."""
    folder = os.environ.get("PULSEGRID_TOKENIZERS")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


PIECES = tokenizer_file("piece_bpe_32k.model")
BYTE_BPE = tokenizer_file("byte_bpe_50k.json")


CODES = vector_codes.CodeConfig(parts=4, entries=256, rounds=4, scale=1024)
PACKING = best_fit_packing.PackConfig(capacity=1024, end_id=2)
CLUSTERS = centroids.ClusterConfig(clusters=16, rounds=3, dims=64, scale=64, seed="1")
#: Production target weights by source; a source that isn't listed has weight 1.
MIX = mixing.MixConfig(weights={"src0": 6, "src1": 4, "src2": 3, "src3": 2}, block_rows=8)


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pfair slot and mixture position of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.schedule(docs, MIX, carried=["doc_id"]).select(
        "doc_id",
        F.col("mix.source").alias("mix_source"),
        F.col("mix.row").alias("source_row"),
        F.col("mix.block").alias("block"),
        F.col("mix.release").alias("release"),
        F.col("mix.deadline").alias("deadline"),
        F.col("mix.slot").alias("slot"),
        F.col("mix.position").alias("position"),
    )


OP1_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS digest, coalesce(text, '') AS text
  FROM documents),
s AS (
  SELECT source, n, w AS a, row_number() OVER (ORDER BY source) AS i FROM (
    SELECT source, count(*) AS n,
      CASE source WHEN 'src0' THEN 6 WHEN 'src1' THEN 4 WHEN 'src2' THEN 3 WHEN 'src3' THEN 2 ELSE 1 END AS w
    FROM d GROUP BY source)),
g AS (SELECT CAST(sum(a) AS BIGINT) AS l, list(CAST(a AS BIGINT) ORDER BY i) AS ws FROM s),
edf(t, done, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(ws, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM g
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(ws) + 1), lambda k: done[k] + CASE WHEN k = choice THEN 1 ELSE 0 END), choice
  FROM (
    SELECT t, done, ws, l, list_min(list_transform(list_filter(range(1, len(ws) + 1), lambda k: (done[k] * l) // ws[k] <= t + 1),
      lambda k: {'deadline': ((done[k] + 1) * l + ws[k] - 1) // ws[k], 'k': k})).k AS choice
    FROM edf, g WHERE t + 1 < l)),
p AS (SELECT t, pick AS i, row_number() OVER (PARTITION BY pick ORDER BY t) AS k FROM edf WHERE t >= 0),
r AS (
  SELECT d.doc_id, d.source, s.a, s.i, row_number() OVER (PARTITION BY d.source ORDER BY digest, text) - 1 AS source_row
  FROM d JOIN s USING (source)),
b AS (SELECT *, source_row // 8 AS j FROM r),
x AS (
  SELECT b.doc_id, b.source AS mix_source, b.source_row, b.j + 1 AS block, (b.j * g.l) // b.a AS "release",
    ((b.j + 1) * g.l + b.a - 1) // b.a AS deadline, (b.j // b.a) * g.l + p.t AS slot
  FROM b JOIN p ON p.i = b.i AND p.k = b.j % b.a + 1 CROSS JOIN g)
SELECT doc_id, mix_source, source_row, block, "release", deadline, slot,
  row_number() OVER (ORDER BY slot, source_row) - 1 AS position
FROM x"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document from the convolutional classifier."""
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from compressed-size differences."""
    return compression_quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by 35-word windows that occur again."""
    return word_repeats.remove_repeated_windows(read_table(spark, sf_dir, "documents"), 35)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at 85 % of their 3-word shingles."""
    cfg = near_dedup.NearDupConfig(shingle=3, percent=85)
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), cfg)


def op6_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, token measures and verdict of every document."""
    return fertility.judge_quality(read_table(spark, sf_dir, "documents"), PIECES)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 100-byte strings that also start earlier."""
    return suffix_dedup.remove_later_copies(read_table(spark, sf_dir, "documents"), 100)


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best segmentations of every document, decoded again."""
    return sentence_pieces.piece_table(read_table(spark, sf_dir, "documents"), PIECES)


def op9_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vec_id divisible by 20."""
    return vector_search.nearest(read_table(spark, sf_dir, "embeddings"), F.pmod("id", F.lit(20)) == 0)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PFOR shards of every whole text, read back per document."""
    return token_files.token_file_table(read_table(spark, sf_dir, "documents"), BYTE_BPE)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors after four Lloyd rounds."""
    return vector_codes.code_table(read_table(spark, sf_dir, "embeddings"), CODES)


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of at most 1024 tokens."""
    return best_fit_packing.pack_documents(read_table(spark, sf_dir, "documents"), BYTE_BPE, PACKING)


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of all vectors after three rounds."""
    return centroids.cluster_table(read_table(spark, sf_dir, "embeddings"), CLUSTERS)


QUERIES = {
    f.__name__: f
    for f in (
        op1_source_mixing,
        op2_toxicity,
        op3_compression_quality,
        op4_substring_dedup,
        op5_minhash_near_dedup,
        op6_tokeniser_fertility,
        op7_suffix_dedup,
        op8_sentence_pieces,
        op9_vector_search,
        op10_token_files,
        op11_vector_codes,
        op12_best_fit_packing,
        op13_centroid_clusters,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_source_mixing": OP1_SQL,
    "op11_vector_codes": vector_sql.code_sql(CODES.parts, CODES.entries, CODES.rounds, CODES.scale, CLUSTERS.dims),
    "op13_centroid_clusters": vector_sql.cluster_sql(CLUSTERS.clusters, CLUSTERS.rounds, CLUSTERS.dims, CLUSTERS.scale, CLUSTERS.seed),
}
