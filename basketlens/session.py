"""SparkSession construction and the shared scratch location.

Settings favour a large cluster: AQE on (runtime coalescing, skew-join
splitting, broadcast conversion by measured size), session time zone pinned
to UTC so second-truncating durations never cross a DST jump.
"""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint() output (the pre-purchase stats) is removed once no plan references it
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "basketlens",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the start of a stream, which takes them over; the
    session gets its own back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_MERGES_LOCK = threading.Lock()
_merging = {"fits": 0, "others": 0, "set": False}


def _count_merging(spark: SparkSession, kind: str, by: int) -> None:
    with _MERGES_LOCK:
        _merging[kind] += by
        key, conf = "spark.default.parallelism", spark.sparkContext._jsc.sc().conf()
        wanted = _merging["fits"] > 0 and not _merging["others"]
        if wanted and not conf.contains(key):
            conf.set(key, str(spark.sparkContext.defaultParallelism))
            _merging["set"] = True
        elif not wanted and _merging["set"]:
            conf.remove(key)
            _merging["set"] = False


@contextmanager
def merges_by_cores(spark: SparkSession):
    """RDD merges by key that start within go to a task per core of the cluster.

    MLlib merges the statistics of each pass over the rows that way, some hundred
    records a task; without ``spark.default.parallelism`` Spark starts as many tasks for
    them as for the rows.  What is merged, and in which order, stays.  A deployer's own
    setting is kept."""
    _count_merging(spark, "fits", 1)
    try:
        yield
    finally:
        _count_merging(spark, "fits", -1)


@contextmanager
def merges_by_partitions(spark: SparkSession):
    """Spark's default again, also while other threads are in ``merges_by_cores``:
    for merges that grow with the rows."""
    _count_merging(spark, "others", 1)
    try:
        yield
    finally:
        _count_merging(spark, "others", -1)


def int_setting(spark: SparkSession, key: str, default: int) -> int:
    """A tuning bound a deployer may set per cluster (``--conf key=value``),
    else the engine's default."""
    value = spark.conf.get(key, None)
    return int(value) if value else int(default)


def _conf(spark: SparkSession, key: str) -> str | None:
    value = spark.sparkContext.getConf().get(key, None)
    if value:
        return value
    try:
        return spark.conf.get(key)
    except Exception:  # unset key
        return None


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; a folder set later with
    ``setCheckpointDir`` comes first.  Only when neither is set (a test session)
    we fall back to the warehouse directory, which is shared storage by the same
    convention, and register it as the checkpoint dir; on a cluster a local
    warehouse folder is refused, as every executor would write to its own disk.
    """
    sc = spark.sparkContext
    root = _conf(spark, "spark.checkpoint.dir")
    current = sc._jsc.sc().getCheckpointDir()
    # Spark adds a folder of its own below the one it was given
    set_to = current.get().rsplit("/", 1)[0] if current.isDefined() else None
    if set_to and (not root or _plain(set_to) != _plain(root)):
        return set_to.rstrip("/")
    if not root:
        root = _conf(spark, "spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        if root.split(":", 1)[0] in ("file", root) and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _plain(path: str) -> str:
    return "/" + path.split(":", 1)[-1].strip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch root; the folder goes when
    the application ends."""
    path = f"{scratch_root(spark)}/basketlens/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path
