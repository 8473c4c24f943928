"""Sinks: A3 features, A4 scored sessions, A5 importances, A6/J15 run rows,
A8 replace-all table, A13 fitted pipelines.

All writes are distributed (no coalesce(1), no driver collect); each task
writes its own part files and Spark's commit protocol makes the job's output
appear atomically, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from basketlens.schemas import SCORED_COLUMNS
from basketlens.session import scratch_root
from basketlens.sources.bucketed import BucketedTable, session_buckets

# bump when a derived table's layout changes (stale tables are never reused)
LAYOUT_VERSION = "v6"


def _norm(p: str) -> str:
    return os.path.normpath(p.replace("file://", "").replace("file:", "")).rstrip("/")


def _inside(child: str, parent: str) -> bool:
    c, p = _norm(child), _norm(parent)
    return c == p or c.startswith(p + "/")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                source_paths: list[str] | None = None, partition_by: list[str] | None = None) -> str:
    """Write a table; refuses to overwrite a folder the frame reads from.

    A path overwrite deletes the target before the job reads it, so writing
    over one's own input loses the data.  Pass ``source_paths`` (the table
    roots read) on large inputs; without them the frame's file list is
    checked, which the driver has to fetch.
    """
    if mode == "overwrite":
        for src in (source_paths if source_paths is not None else df.inputFiles()):
            if _inside(src, path) or _inside(path, src):
                raise ValueError(f"refusing to overwrite {path}: the frame reads from {src}")
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def scored_columns(df: DataFrame) -> list[str]:
    """The fixed scored-row column list, restricted to columns present."""
    present = set(df.columns)
    return [c for c in SCORED_COLUMNS if c in present]


def save_scored_sessions(scored: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A4: scored rows with the class-1 probability (computed before the column
    filter, so it is kept)."""
    return write_table(scored.select(*scored_columns(scored)), path, mode=mode)


def fingerprint(spark: SparkSession, source: str) -> str:
    """Changes when files below ``source`` are added, removed or change in size:
    bytes, number of files and folders, and the modification times of the folder and
    its tables.  Answered by the file system, without reading data.  A nested file
    rewritten at the same length is not seen; the incremental roll-up, which lists
    every file with its time, does see it."""
    path = source[4:] if source.startswith("csv:") else source
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(folder)
    facts = [source.rstrip("/")]
    for status in found or []:
        total = fs.getContentSummary(status.getPath())
        facts += [total.getLength(), total.getFileCount(), total.getDirectoryCount(), status.getModificationTime()]
    for table in ("events", "part"):
        part = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{table}.parquet")
        if fs.exists(part):
            facts.append(fs.getFileStatus(part).getModificationTime())
    return hashlib.sha1(repr(facts).encode()).hexdigest()[:12]


def dataset_workspace(spark: SparkSession, source: str) -> str:
    """Folder of a dataset's derived tables and runs under the shared scratch
    root; a changed dataset gets another one."""
    return f"{scratch_root(spark)}/basketlens/{LAYOUT_VERSION}/{fingerprint(spark, source)}"


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed because the table isn't there (or has no file yet)."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


_COMPLETE: dict[str, str] = {}     # table -> folder of its complete data
_BUILD_LOCK = threading.RLock()


def _complete(spark: SparkSession, path: str) -> str | None:
    """The data folder that the table's marker names, None without a marker."""
    try:
        row = spark.read.schema("folder string").parquet(f"{path}/complete").orderBy("folder").first()
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return None
    return row["folder"] if row else None


def materialized(spark: SparkSession, path: str, build, schema=None, bucketed_by: tuple[str, ...] = ()) -> DataFrame:
    """Read a written table, writing it first when absent or incomplete.

    The data goes to a folder of its own; a one-row marker naming it is added
    only after the write job has committed.  A run that died half-way leaves no
    marker, and applications that build the same table at once write apart:
    whichever marker sorts first is the table for all.  The marker is read
    once per process; a known ``schema`` spares the read its inference job.
    With ``bucketed_by`` the table is bucketed and sorted by those columns; the
    folder's name keeps its number of buckets."""
    if path not in _COMPLETE:
        with _BUILD_LOCK:                    # queries run from several threads build once
            if path not in _COMPLETE:
                folder = _complete(spark, path)
                if folder is None:
                    buckets = session_buckets(spark) if bucketed_by else 0
                    mine = f"{path}/data-{uuid.uuid4().hex[:12]}-{buckets}b"
                    data = build()
                    if bucketed_by:
                        BucketedTable(mine, data.schema, bucketed_by, buckets).append(data)
                    else:
                        data.write.parquet(mine)
                    spark.createDataFrame([(mine,)], "folder string").write.mode("append").parquet(f"{path}/complete")
                    folder = _complete(spark, path)
                _COMPLETE[path] = folder
    folder = _COMPLETE[path]
    if bucketed_by:
        buckets = int(folder.rsplit("-", 1)[1][:-1])
        return BucketedTable(folder, schema or build().schema, bucketed_by, buckets).read(spark)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(folder)
