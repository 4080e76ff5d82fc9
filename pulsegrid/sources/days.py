"""Tables kept by day: a folder ``dt=YYYY-MM-DD`` for each, read in ranges and replaced a day at a time.

Only the folders of the wanted days are listed, so a read costs the same however many
days a table has.  Files that can't be read are skipped; columns that some days lack are null
there.

A day is written as a new version, a folder ``v=N`` of its own, and becomes visible all at once
when the empty file ``_v=N`` is created after it; readers take the version with the largest such
number.  A write that is lost half-way leaves the version before in place, and two writers
can't publish one number.  The last ``KEPT`` versions stay, so earlier ones can be read too.  A
folder that holds plain files, written by others, is read as it is.  Forests are kept the same way.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASELINE_KEYS = ("uuid", "date", "baseline_ready", "early_ready", "cold_stage")
BASELINE_KINDS = ("lt_g", "st_g", "st_s", "early_g", "early_s", "final")


def as_day(day: str | dt.date) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def today(tz_minutes: int = 540) -> dt.date:
    """The date now at an offset from UTC."""
    return (dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=tz_minutes)).date()


def day_folder(root: str, day: str | dt.date) -> str:
    return f"{root.rstrip('/')}/dt={as_day(day)}"


#: Versions of a folder that stay after a newer one is published.
KEPT = 2


def _files(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    path, fs = _files(spark, pattern)
    return [f.getPath().toString() for f in fs.globStatus(path(pattern)) or []]


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the published versions of a folder, ascending."""
    return sorted(int(f.rsplit("=", 1)[1]) for f in _listed(spark, f"{folder.rstrip('/')}/_v=*"))


def current(spark: SparkSession, folder: str, version: int | None = None) -> str:
    """Where the files of the folder's newest, or the given, version are."""
    known = versions(spark, folder)
    if version is not None and version not in known:
        raise FileNotFoundError(f"no version {version} of {folder}")
    return f"{folder.rstrip('/')}/v={version if version is not None else known[-1]}" if known else folder.rstrip("/")


def publish(spark: SparkSession, folder: str, write: Callable[[str], None]) -> str:
    """``write`` puts files into a fresh folder, which then becomes the current version; its path."""
    folder = folder.rstrip("/")
    path, fs = _files(spark, folder)
    taken = [int(f.rsplit("=", 1)[1]) for f in (*_listed(spark, f"{folder}/v=*"), *_listed(spark, f"{folder}/_v=*"))]
    number = max(taken, default=0) + 1
    write(f"{folder}/v={number}")
    fs.create(path(f"{folder}/_v={number}"), False).close()  # an error where another writer has published it
    for old in versions(spark, folder)[: -KEPT - 1]:
        fs.delete(path(f"{folder}/_v={old}"), False)
        fs.delete(path(f"{folder}/v={old}"), True)
    return f"{folder}/v={number}"


def days_with_files(spark: SparkSession, root: str, days: Sequence[dt.date]) -> list[str]:
    """The folders of those of the days that have a Parquet file: published versions, else plain ones."""
    if not days:
        return []
    base = f"{root.rstrip('/')}/dt={{{','.join(map(str, days))}}}"
    newest: dict[str, int] = {}
    for mark in _listed(spark, f"{base}/_v=*"):
        day, number = mark.rsplit("/_v=", 1)
        newest[day] = max(newest.get(day, 0), int(number))
    found = {f.rsplit("/", 1)[0] for f in _listed(spark, f"{base}/*.parquet")} - newest.keys()
    held = {f.rsplit("/", 1)[0] for f in _listed(spark, f"{base}/v=*/*.parquet")}
    return sorted(found | {f for f in held if (day := f.rsplit("/v=", 1))[0] in newest and newest[day[0]] == int(day[1])})


def read_range(spark: SparkSession, root: str, first: str | dt.date, last: str | dt.date) -> DataFrame | None:
    """All rows of the days from ``first`` to ``last``, both included; None where no such day has files."""
    first, last = as_day(first), as_day(last)
    folders = days_with_files(spark, root, [first + dt.timedelta(days=i) for i in range((last - first).days + 1)])
    if not folders:
        return None
    reader = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True)
    return reader.parquet(*folders)


def read_day(spark: SparkSession, root: str, day: str | dt.date) -> DataFrame:
    """All rows of one day; an error where there are none."""
    rows = read_range(spark, root, day, day)
    if rows is None:
        raise FileNotFoundError(f"no files of {day} under {root}")
    return rows


def read_lookback(spark: SparkSession, root: str, day: str | dt.date, days: int = 31) -> DataFrame:
    """The ``days`` days that end with ``day``; days without files are skipped, none at all is an error."""
    rows = read_range(spark, root, as_day(day) - dt.timedelta(days=days - 1), day)
    if rows is None:
        raise FileNotFoundError(f"no files of the {days} days up to {day} under {root}")
    return rows


def read_training(spark: SparkSession, root: str, as_of: str | dt.date | None = None, lookback: int = 30) -> DataFrame | None:
    """The day ``as_of`` (yesterday, if not given) and ``lookback`` days before it; None where none has files."""
    end = as_day(as_of) if as_of else today() - dt.timedelta(days=1)
    return read_range(spark, root, end - dt.timedelta(days=lookback), end)


def write_day(rows: DataFrame, root: str, day: str | dt.date) -> None:
    """Replaces one day of a table."""
    publish(rows.sparkSession, day_folder(root, day), rows.write.parquet)


def _of_day(rows: DataFrame, day: str | dt.date) -> DataFrame:
    return rows.where(F.col("date").cast("date") == F.lit(as_day(day)))


def write_baseline(rows: DataFrame, root: str, day: str | dt.date) -> bool:
    """Replaces the day's baselines (means and deviations of every kind); False, and nothing written, where it has no rows."""
    ends = tuple(f"_{stat}_{kind}" for kind in BASELINE_KINDS for stat in ("mean", "std"))
    found = _of_day(rows, day).select(*[c for c in BASELINE_KEYS if c in rows.columns], *[c for c in rows.columns if c.endswith(ends)])
    if found.isEmpty():
        return False
    write_day(found, root, day)
    return True


def write_state(states: DataFrame, root: str, day: str | dt.date) -> bool:
    """Replaces the day's states as CSV with a header; False, and nothing written, where it has no rows."""
    found = _of_day(states, day)
    if found.isEmpty():
        return False
    publish(found.sparkSession, day_folder(root, day), lambda path: found.write.csv(path, header=True))
    return True


def read_state(spark: SparkSession, root: str, day: str | dt.date) -> DataFrame:
    """The day's states, every column as text."""
    return spark.read.csv(current(spark, day_folder(root, day)), header=True)


def model_path(uri: str) -> str:
    """Where a forest lies: the table itself, or below a prefix."""
    return uri if uri.rstrip("/").endswith(".parquet") else f"{uri.rstrip('/')}/isolation_forest.parquet"


def save_model(forest: DataFrame, uri: str) -> str:
    """Publishes the node table of a forest as the newest version; its path."""
    return publish(forest.sparkSession, model_path(uri), forest.write.parquet)


def load_model(spark: SparkSession, uri: str, version: int | None = None) -> DataFrame:
    """The newest forest, or the given version."""
    return spark.read.parquet(current(spark, model_path(uri), version))


def public_features(spark: SparkSession, uri: str) -> DataFrame:
    """A table of daily features: a Parquet file, or the first by name below a folder, as later ones are older exports.

    A folder that Spark wrote as one table (its files begin with ``part-``) is read whole.
    """
    if uri.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(uri)
    found = sorted(f for f in _listed(spark, f"{uri.rstrip('/')}/*.parquet"))
    if not found:
        raise FileNotFoundError(f"no Parquet file under {uri}")
    return spark.read.parquet(uri if found[0].rsplit("/", 1)[1].startswith("part-") else found[0])


# The order of columns in exported feature files, differences after them.
EXPORT_ORDER = (
    "uuid", "date", "Screen", "UserAct", "Notif", "unlock_cnt", "daily_event_cnt", "has_activity",
    "qc_core_low_cov", "qc_core_very_low_activity", "qc_rhythm_low_cov", "qc_gap_low_cov", "qc_meta_low_heartbeat", "qc_meta_retry_warn", "qc_meta_queue_warn",
    "partial_signal_raw", "travel_signal_raw", "tz_change_signal",
    "rhythm_event_cnt", "rhythm_low_coverage", "night_ratio", "hour_entropy", "day_ratio", "evening_ratio", "peak_hour", "peak_ratio",
    "gap_event_cnt", "gap_low_coverage", "gap_max", "gap_p95", "gap_cnt_2h", "gap_cnt_6h", "gap_long_ratio", "overnight_gap", "first_hour", "last_hour",
    "session_cnt", "session_total_sec", "session_mean_sec", "long_session_cnt",
    "cell_change_cnt", "wifi_change_cnt_est", "unique_wifi_cnt", "unique_cell_cnt", "step_sum",
    "heartbeat_cnt", "retry_max", "queue_max", "tz_offset_min", "tz_offset_max", "tz_changed", "qc_last_ts_max",
)


def write_export(rows: DataFrame, path: str, order: Sequence[str] = EXPORT_ORDER) -> None:
    """CSV files in UTF-8 with a byte order mark: columns in the given order, as far as the table has them, then the differences.

    Without an order, all columns as they are.  Every file has the header, so each can be opened alone.
    """
    columns = [c for c in order if c in rows.columns] + [c for c in rows.columns if c.endswith(("_d1", "_r1"))] if order else rows.columns
    first, *rest = columns
    rows.select(F.col(first).alias(f"\ufeff{first}"), *rest).write.csv(path, header=True)
