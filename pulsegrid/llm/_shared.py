"""Helpers that every corpus operator uses: scratch tables, partition counts, input checks."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_BYTES = 4 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only where neither the setting nor a checkpoint directory exists and all of
    Spark runs in one process (tests) a temporary folder is made and registered as
    checkpoint directory of the session; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/pulsegrid-{name}-{uuid.uuid4().hex}"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches for Python of at most ``BATCH_BYTES``, where the session hasn't its own limit.

    Texts may be long, so a limit on rows alone doesn't bound a worker's memory.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # the default
        spark.conf.set(key, str(BATCH_BYTES))


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`materialise` writes inside are deleted at the end, all but the last."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop()[:-1]:
            _delete(spark, path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it (short lineage)."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`materialise` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/pulsegrid-" in folder:
            _delete(df.sparkSession, folder)


def release_shuffles(spark: SparkSession) -> None:
    """Let the context cleaner drop shuffle files of finished jobs now, not at some later collection.

    The first round frees the driver's Python handles, the second what they held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores after it where a column already has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, text string) of a document table; a null text counts as empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
