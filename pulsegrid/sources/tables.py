"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where all of Spark runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table and read again: computed once, with a short plan, and kept if executors are lost."""
    path = f"{shared_folder(df.sparkSession)}/pulsegrid-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
