"""MinHash near-duplicate detection with min-max signatures and exact confirmation.

Each permutation of a document's shingle hashes gives two signature values, its
minimum and its maximum, so half as many hash evaluations fill the bands.
Documents that agree on a band are candidates; every link that is reported has
been confirmed on the full shingle sets.

Bands are resolved without listing all pairs of a group:

1. documents with equal shingle sets are one class, represented by its least id;
2. each band bucket is compared with one pivot (its least id), links are
   contracted to components;
3. only buckets that still hold several components go on.  Among their
   documents, the shingles that occur in at least two of them are counted: a
   document whose shared shingles are fewer than the threshold's share of its
   set can have no further link and leaves (exact bound).  The document with
   the largest shared part is the next pivot of its bucket, and of its cluster
   (buckets chained by common documents);
4. for what is still apart, each document is written as its difference to the
   cluster's pivot p: shingles of p that it lacks, and shingles that p lacks.  If x
   isn't linked to p, any y that x is linked to has at least
   c = (t(|p| + a_x + a_y) - |p| + m_x + m_y) / (1 + t) differences in common with
   x, where m and a count lacked and added shingles and t is the threshold.
   So the two share one of their first (differences - c + 1), in any fixed order;
   pairs that do are confirmed.  The order is by how many members of the cluster have
   a difference, the rarest first, so that one that is common to many leads to few
   pairs.  This misses none, whatever the group's size.

The number of rows of a band is chosen so that a pair at the threshold is missed
by all bands with a probability under one in a million.

Cases: rows with a null doc_id are not linked (component null, kept); rows that
share a doc_id count as one document; null and empty texts and texts without a
word have no shingle and no link; an empty table gives an empty result; columns
other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text
from ._shared import discard, materialise, release_shuffles, scratch_scope, texts
from .components import component_labels

MISS = 1e-6
MEMBERS_PER_TASK_GROUP = 2000


@dataclass(frozen=True)
class NearDupConfig:
    """``shingle`` words a shingle, links at ``percent`` of the union or more, ``permutations`` evaluated."""

    shingle: int = 5
    percent: int = 80
    permutations: int = 64

    def bands(self) -> tuple[int, int]:
        """(bands, rows): the longest bands that still miss under ``MISS`` of the pairs at the threshold."""
        values, t = 2 * self.permutations, self.percent / 100
        fits = [(values // r, r) for r in range(1, 13) if (1 - t**r) ** (values // r) <= MISS]
        return fits[-1]


def _min_max(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima then maxima of the permuted hashes, a slice of the set at a time."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(a), np.uint64)
    for k in range(0, len(hashes), 16384):
        permuted = hashes[k : k + 16384, None] * a + b
        np.minimum(low, permuted.min(0), out=low)
        np.maximum(high, permuted.max(0), out=high)
    return np.concatenate([low, high])


def _set_of(text: str, width: int) -> np.ndarray:
    return _text.shingles(_text.lower_ascii(_text.to_bytes(text)), width)


def signatures(docs: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """(doc_id, n_shingles, digest, keys): size and digest of the set, and one key a band."""
    n_bands, rows = cfg.bands()
    draw = np.random.default_rng(7)
    a = draw.integers(1, 2**63, cfg.permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = draw.integers(0, 2**63, cfg.permutations, dtype=np.uint64)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import blake2b

        salt = np.arange(1, n_bands + 1, dtype=np.uint64)
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch["text"]:
                hashes = _set_of(text, cfg.shingle)
                sizes.append(len(hashes))
                digests.append(blake2b(hashes.tobytes(), digest_size=16).digest())
                if len(hashes):
                    sig = _min_max(hashes, a, b)[: n_bands * rows].reshape(n_bands, rows)
                    key = salt.copy()
                    for r in range(rows):
                        key = _text.mix(key + sig[:, r])
                    keys.append(key.view(np.int64))
                else:
                    keys.append(np.empty(0, np.int64))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_shingles": sizes, "digest": digests, "keys": keys})

    return docs.mapInPandas(sign, "doc_id bigint, n_shingles bigint, digest binary, keys array<bigint>")


def confirm(pairs: DataFrame, corpus: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold.

    Texts travel once for each pair they are a member of; a pivot's text comes
    as a row of its own, before its members.  The members of a large pivot are
    dealt to several groups, each with its own copy of the pivot.
    """
    width, percent = cfg.shingle, cfg.percent

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, pivots = None, []
        for batch in batches:
            us, vs = [], []
            for a, part, b, text in zip(batch["a"], batch["part"], batch["b"], batch["text"]):
                own = _set_of(text, width)
                if (a, part) != group:
                    group, pivots = (a, part), []
                if a == b:
                    pivots.append(own)
                    continue
                for pivot in pivots:
                    both = len(np.intersect1d(pivot, own, assume_unique=True))
                    if 100 * both >= percent * (len(pivot) + len(own) - both):
                        us.append(a)
                        vs.append(b)
                        break
            yield pd.DataFrame({"u": us, "v": vs}, dtype="int64")

    return _dealt(pairs, corpus).mapInPandas(check, "u bigint, v bigint")


def _dealt(pairs: DataFrame, corpus: DataFrame, *more: str) -> DataFrame:
    """(a, part, b, text, more...): for each pivot and part, the pivot's own row (a = b), then its members."""
    sized = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_PER_TASK_GROUP).alias("parts"))
    heads = sized.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("a").alias("b"))
    members = pairs.join(sized, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), "b", *more)
    rows = heads.unionByName(members, allowMissingColumns=True).join(corpus.withColumnRenamed("doc_id", "b"), "b")
    dealt = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b") != F.col("a"))
    return dealt.select("a", "part", "b", "text", *more)


def first_differences(size: int, lacked: np.ndarray, added: np.ndarray, percent: int) -> tuple[np.ndarray, int, int]:
    """(differences, how many come first if the partner isn't linked to the pivot, how many if only this document isn't).

    ``size`` is the pivot's.  A lacked shingle is told apart from an added one by its last bit.
    """
    m, a = len(lacked), len(added)
    both = np.concatenate([added | np.uint64(1), lacked & ~np.uint64(1)])
    partner_apart = (percent * a + 100 * m) // (100 + percent) + 1
    self_apart = max(1, -(-(percent * (size + a) - 100 * size + 100 * m) // 100))
    short = max(0, m + a - partner_apart + 1)
    return both, short, max(short, m + a - self_apart + 1)


def difference_pairs(members: DataFrame, corpus: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """Pairs (a, b) that may still be linked, from members (a: pivot, b, apart, label).

    ``apart`` says that the member isn't in the pivot's component.  A pair has at
    least one such member, which by then has been tested against the pivot.
    """
    width, percent = cfg.shingle, cfg.percent

    def differ(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivot = np.empty(0, np.uint64)
        for batch in batches:
            out: list[tuple] = []
            for a, b, text, apart, label in zip(batch["a"], batch["b"], batch["text"], batch["apart"], batch["label"]):
                own = _set_of(text, width)
                if a == b:
                    pivot = own
                    continue
                lacked, added = np.setdiff1d(pivot, own, True), np.setdiff1d(own, pivot, True)
                found, short, long = first_differences(len(pivot), lacked, added, percent)
                out += [(a, b, bool(apart), int(label), x, short, long if apart else short) for x in np.unique(found.view(np.int64)).tolist()]
            yield pd.DataFrame(out, columns=["a", "b", "apart", "label", "difference", "n_short", "n_long"])

    rows = materialise(
        _dealt(members, corpus, "apart", "label").mapInPandas(
            differ, "a bigint, b bigint, apart boolean, label bigint, difference bigint, n_short bigint, n_long bigint"
        ),
        "differences",
    )
    counts = materialise(rows.groupBy("a", "difference").agg(F.count("*").alias("n")), "difference-counts")
    rarest = Window.partitionBy("a", "b").orderBy("n", "difference")
    rows = rows.join(counts, ["a", "difference"]).withColumn("k", F.row_number().over(rarest)).where("k <= n_long and n > 1")
    rows = materialise(rows.select("a", "b", "apart", "label", "difference", (F.col("k") <= F.col("n_short")).alias("short")), "first-differences")
    left = rows.where("apart").select("a", "difference", F.col("b").alias("x"), F.col("short").alias("x_short"), F.col("label").alias("x_label"))
    right = rows.where("short")
    met = left.join(right, ["a", "difference"]).where("x_label != label and (not apart or (x_short and x < b))")
    return met.select(F.least("x", "b").alias("a"), F.greatest("x", "b").alias("b")).distinct()


def _with_labels(keyed: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds each representative's component, and keeps the buckets that hold several of them."""
    known = keyed.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    split = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("key")
    return known.join(split, "key", "left_semi")


def _shared_sizes(members: DataFrame, corpus: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """(rep, size, shared, popular): set size, how many of its shingles another member has too, and in how many members those occur, summed up."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 200):
                part = batch.iloc[k : k + 200]
                yield pd.DataFrame({"rep": part["doc_id"], "shingles": [_set_of(t, cfg.shingle).view(np.int64) for t in part["text"]]})

    each = (
        corpus.join(members.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
        .mapInPandas(sets, "rep bigint, shingles array<bigint>")
        .select("rep", F.explode("shingles").alias("shingle"))
    )
    each = materialise(each, "member-shingles")
    common = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    common = materialise(common, "common-shingles")  # so that a very common one can be split in the join
    counted = each.join(common, "shingle", "left").groupBy("rep")
    return counted.agg(F.count("*").alias("size"), F.count("n").alias("shared"), F.coalesce(F.sum("n"), F.lit(0)).alias("popular"))


def near_duplicate_links(docs: DataFrame, cfg: NearDupConfig) -> tuple[DataFrame, DataFrame]:
    """(signed, labels): a row for each document with its class representative, and components of representatives."""
    docs = texts(docs)
    signed = materialise(signatures(docs, cfg), "signatures")
    usable = signed.where("doc_id is not null and n_shingles > 0")
    # equal sets meet in partial aggregates, never row by row
    reps = materialise(usable.groupBy("digest").agg(F.min(F.struct("doc_id", "keys")).alias("r")).select("digest", F.col("r.doc_id").alias("rep"), "r.keys"), "classes")
    classes = reps.select("digest", "rep")
    exploded = reps.select("rep", F.explode("keys").alias("key"))
    shared = exploded.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo != hi")
    keyed = materialise(exploded.join(shared.select("key", F.col("lo").alias("pivot")), "key").distinct(), "bands")
    corpus = materialise(docs.join(keyed.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "candidates")
    release_shuffles(docs.sparkSession)

    tested = materialise(keyed.where("rep != pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    edges = materialise(confirm(tested, corpus, cfg), "links")
    # Rows of one document with different texts are one node from here on.
    labels = component_labels(edges)

    open_ = materialise(_with_labels(keyed.select("key", "rep"), labels), "open")
    if not open_.isEmpty():
        sizes = materialise(_shared_sizes(open_.select("rep").distinct(), corpus, cfg), "shared")
        alive = sizes.where(f"100 * shared >= {cfg.percent} * size")
        open_ = materialise(open_.join(alive, "rep"), "open")
        best = F.max(F.struct(F.col("shared") / F.col("size"), -F.col("rep"), "label")).alias("p")
        lead = open_.groupBy("key").agg(best).select("key", (-F.col("p.col2")).alias("a"), F.col("p.label").alias("a_label"))
        by_bucket = open_.join(lead, "key").where("label != a_label").select("a", F.col("rep").alias("b"))
        tie = open_.groupBy("key").agg(F.min("rep").alias("v"))
        chained = component_labels(open_.join(tie, "key").select(F.col("rep").alias("u"), "v"))
        nodes = open_.select("rep", "label", "size", "popular").distinct()
        nodes = nodes.join(chained.select(F.col("node").alias("rep"), F.col("label").alias("cluster")), "rep", "left")
        nodes = nodes.withColumn("cluster", F.coalesce("cluster", "rep"))
        # the member that has most in common with all: what it alone lacks would be a difference of every other
        sums = materialise(nodes.groupBy("cluster").agg(F.count("*").alias("members"), F.sum("size").alias("sizes")), "cluster-sizes")
        alike = F.col("popular") / (F.col("size") + F.col("sizes") / F.col("members"))
        central = F.max(F.struct(alike, -F.col("rep"), "label")).alias("p")
        head = nodes.join(sums, "cluster").groupBy("cluster").agg(central).select("cluster", (-F.col("p.col2")).alias("a"), F.col("p.label").alias("a_label"))
        head = materialise(head, "cluster-heads")
        nodes = materialise(nodes.join(head, "cluster").select("rep", "a", "label", "a_label"), "clusters")
        by_cluster = nodes.where("label != a_label").select("a", F.col("rep").alias("b"))
        fresh = materialise(by_bucket.union(by_cluster).distinct().join(_both_ways(tested), ["a", "b"], "left_anti"), "pairs")
        labels = _more_labels(materialise(confirm(fresh, corpus, cfg), "links"), labels)
        tested = tested.union(fresh)

        rest = _with_labels(open_.select("key", "rep"), labels).select("rep").distinct()
        named = labels.withColumnRenamed("label", "now")
        members = nodes.join(rest, "rep", "left_semi").select("a", F.col("rep").alias("b")).where("a != b")
        members = members.join(named.withColumnRenamed("node", "b"), "b", "left").withColumn("label", F.coalesce("now", "b")).drop("now")
        members = members.join(named.withColumnRenamed("node", "a"), "a", "left").withColumn("apart", F.col("label") != F.coalesce("now", "a")).drop("now")
        last = difference_pairs(materialise(members, "members"), corpus, cfg).join(_both_ways(tested), ["a", "b"], "left_anti")
        last = materialise(last, "pairs")
        labels = _more_labels(materialise(confirm(last, corpus, cfg), "links"), labels)
    discard(keyed)
    rows = signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
    rows = rows.join(classes, "digest", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")), labels


def _more_labels(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels after some more links, from those already known."""
    return labels if links.isEmpty() else component_labels(links, labels)


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def near_duplicates(docs: DataFrame, cfg: NearDupConfig = NearDupConfig()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs(doc_id, text)``."""
    with scratch_scope(docs.sparkSession):
        rows, labels = near_duplicate_links(docs, cfg)
        out = rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        component = F.coalesce("label", "rep")
        out = out.select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
        return materialise(out, "near-duplicates")


def without_near_duplicates(docs: DataFrame, cfg: NearDupConfig = NearDupConfig()) -> DataFrame:
    """One document of each group of near duplicates, with all its columns; rows without an id all stay.

    Rows that share a kept doc_id are one document; the one with the least text stays.
    """
    kept = near_duplicates(docs, cfg).where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept_id")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("_id"), "text")
    rows = rows.where("_id is not null").join(kept, F.col("_id") == F.col("_kept_id"), "left_semi")
    order = F.struct(F.coalesce("text", F.lit("")).alias("t"), "doc")
    one = rows.groupBy("_id").agg(F.min(order).alias("o")).select("o.doc.*")
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
