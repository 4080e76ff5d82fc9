"""CSV files of events, one file a user or a sensor, whose headers may differ."""

from __future__ import annotations

import csv
import warnings
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pulsegrid.sources.events import from_public_csv

#: Column of a row that has too many or too few fields, with its whole line.
BROKEN = "_broken_line"


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The files among the paths; a warning names the others."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf, there = spark.sparkContext._jsc.hadoopConfiguration(), []
    for p in paths:
        if path(p).getFileSystem(conf).exists(path(p)):
            there.append(p)
        else:
            warnings.warn(f"{p} skipped: no such file", stacklevel=3)
    return there


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the column names of their first line: one job, whatever the number of files.

    Only the first line of each file leaves its task.
    """
    lines = spark.read.option("ignoreCorruptFiles", True).text([*paths])
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("line"))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for r in first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).collect():  # a row a header
        names = next(csv.reader([r["line"].lstrip("\ufeff")]), [])
        groups[tuple(names)] += r["files"]
    return dict(sorted(groups.items()))


def _scans(spark: SparkSession, paths: Sequence[str], user_from_name: bool) -> list[DataFrame]:
    out = []
    for names, files in headers(spark, existing(spark, paths)).items():
        schema = StructType([StructField(n, StringType()) for n in (*names, BROKEN)])
        reader = spark.read.schema(schema).option("ignoreCorruptFiles", True)
        scan = reader.csv(files, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN, enforceSchema=True)
        if user_from_name:
            scan = scan.withColumn("uuid", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.csv)?$", 1))
        parsed = F.length(F.coalesce(*[F.col(f"`{n}`") for n in names], F.lit(""))) >= 0  # so that some column is always read
        out.append(scan.where(parsed).withColumn("_file", F.col("_metadata.file_path")))
    if not out:
        raise FileNotFoundError("no CSV file could be read")
    return out


def read_csv_files(spark: SparkSession, paths: Sequence[str], user_from_name: bool = False) -> DataFrame:
    """All whole rows of the files, every column as text, united by column name; files of one header are one scan.

    A file that isn't there or can't be read is skipped; none left is an error.  Rows with more or fewer
    fields than their header has are left to :func:`broken_rows`.  ``user_from_name``
    makes the file's name without its ending the ``uuid``.
    """
    scans = [s.where(F.col(BROKEN).isNull()).drop(BROKEN, "_file") for s in _scans(spark, paths, user_from_name)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def broken_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, line) of the rows that :func:`read_csv_files` leaves out."""
    scans = [s.select(F.col("_file").alias("file"), F.col(BROKEN).alias("line"), *[c for c in s.columns if c not in ("_file", BROKEN)]) for s in _scans(spark, paths, False)]
    return reduce(DataFrame.unionByName, [s.where("line is not null").select("file", "line") for s in scans])


def read_public(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Public sensor files under the names that events have."""
    return from_public_csv(read_csv_files(spark, paths))
