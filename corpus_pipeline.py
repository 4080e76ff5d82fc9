"""The corpus pipeline: five operators of the llm subpackage one after another.

Each stage gets all that the one before kept, as a table written and read again;
the last gives the encoded documents in the order of the mixture, each with its
position in it.  The stages before keep the columns of documents, and a table read
again has lost the order of its rows; so the last stage computes the positions of the
rows it gets, which depend on nothing but these rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import mixing, near_dedup, sentence_pieces, suffix_dedup, toxicity
from pulsegrid.llm._shared import materialise, read_table, release_shuffles, shuffle_partitions
from pulsegrid.llm.queries import MIX, PIECES

TOXIC_FROM = float(os.environ.get("PULSEGRID_TOXIC_FROM", "0.7"))
NEAR_DUPLICATES = near_dedup.NearDupConfig(shingle=5, percent=80)
COPY_BYTES = 100


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier lets pass."""
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"), TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.without_near_duplicates(docs, NEAR_DUPLICATES)


def cut_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has."""
    return suffix_dedup.without_later_copies(docs, COPY_BYTES)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in the order of the mixture."""
    return mixing.mixed(docs, MIX, shuffle_partitions(spark))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the mixture: identity, position, piece ids, the text they decode to, and the distance of the second segmentation."""
    placed = mixing.mixed(docs.select("doc_id", "lang", "source", "text"), MIX, shuffle_partitions(spark), "position")
    coded = sentence_pieces.encode(placed, PIECES, n_best=2)
    best = F.get("segmentations", F.lit(0))
    coded = coded.select(
        "position",
        "doc_id",
        "lang",
        "source",
        best["ids"].alias("ids"),
        F.size(best["ids"]).cast("long").alias("n_pieces"),
        best["score"].alias("score"),
        (best["score"] - F.get("segmentations", F.lit(1))["score"]).alias("second_gap"),
    )
    return sentence_pieces.decode(coded, PIECES, out_col="decoded")


def _from_clean(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, begun when the driver has given up what the jobs of the one before held: shuffles, broadcasts, compiled plans."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_shuffles(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", _from_clean(drop_toxic)),
    ("near_dedup", _from_clean(drop_near_duplicates)),
    ("suffix_dedup", _from_clean(cut_copies)),
    ("mixing", _from_clean(mix_sources)),
    ("sentence_pieces", _from_clean(encode_pieces)),
]

#: The classifier can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
