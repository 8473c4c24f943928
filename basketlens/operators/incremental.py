"""C1-C7, D1 kept up to date: a session roll-up that reads new event files only.

Every event file is folded once into mergeable partials, one row per (session,
category): counts, time range, price sum and count, first purchase.  A fold adds
one version to a table bucketed by session, so merging the versions and rolling
them up to sessions needs no exchange.  A manifest names the files that are folded
in and the versions that hold them; it is written last and decides what counts, so
a fold that died leaves nothing behind that a reader sees, and is simply repeated.

Versions are merged into one when there are more than ``MAX_VERSIONS``: reading
stays a scan of a few files per bucket, and the cost of a merge is spread over
that many folds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlens.functions.columns import whole_seconds_between
from basketlens.operators.clean import clean_events, observed_counts
from basketlens.operators.sessions import session_category_counts
from basketlens.schemas import UNKNOWN_CATEGORY
from basketlens.sources.bucketed import BucketedTable, session_buckets
from basketlens.sources.commits import CommitLog, list_files

MAX_VERSIONS = 8

PARTIAL_SCHEMA = (
    "user_session string, category_main string, n_events bigint, n_views bigint, n_cart_adds bigint, "
    "n_purchases bigint, t_first timestamp_ntz, t_last timestamp_ntz, price_sum double, price_count bigint, "
    "t_first_purchase timestamp_ntz, version string")
MANIFEST_SCHEMA = "file string, bytes long, modified long, fold int, version string, n_raw long, n_clean long"


def merged_partials(partials: DataFrame) -> DataFrame:
    """One row per (session, category) from several."""
    sums = [F.sum(c).alias(c) for c in ("n_events", "n_views", "n_cart_adds", "n_purchases")]
    return partials.groupBy("user_session", "category_main").agg(
        *sums, F.min("t_first").alias("t_first"), F.max("t_last").alias("t_last"),
        F.sum("price_sum").alias("price_sum"), F.sum("price_count").alias("price_count"),
        F.min("t_first_purchase").alias("t_first_purchase"))


def rollup_of_partials(partials: DataFrame) -> DataFrame:
    """The rows of ``session_rollup`` from (merged or unmerged) partials."""
    cells = merged_partials(partials)
    cat = F.col("category_main")
    known = cat.isNotNull()

    def of_known(c):
        return F.coalesce(F.sum(F.when(known, F.col(c))), F.lit(0))

    # most events first, then the smaller name; the earliest timed purchase, then the smaller name
    main = F.min(F.when(known, F.struct((-F.col("n_events")).alias("minus"), cat.alias("c"))))["c"]
    bought = F.min(F.when(known & (F.col("n_purchases") > 0), F.struct(
        F.col("t_first_purchase").isNull().alias("untimed"), F.col("t_first_purchase").alias("t"), cat.alias("c"))))["c"]
    price_sum = F.sum(F.when(known, F.col("price_sum")))
    agg = cells.groupBy("user_session").agg(
        of_known("n_views").alias("num_views"), of_known("n_cart_adds").alias("num_cart_adds"),
        of_known("n_purchases").alias("num_purchases"), F.min(F.when(known, F.col("t_first"))).alias("session_start"),
        F.max(F.when(known, F.col("t_last"))).alias("session_end"),
        F.try_divide(price_sum, of_known("price_count")).alias("avg_price"), main.alias("main_category"),
        F.count(cat).alias("unique_categories"),
        F.max(F.when(F.col("n_purchases") > 0, 1).otherwise(0)).alias("label"), bought.alias("label_category"),
        of_known("n_events").alias("n_categorized"))
    return agg.withColumns({
        "session_duration": whole_seconds_between("session_start", "session_end"),
        "main_category": F.coalesce("main_category", F.lit(UNKNOWN_CATEGORY))})


class IncrementalRollup:
    """The roll-up kept under ``path`` (in a shared folder).

    ``read(files)`` gives the raw events (T1 columns) of a list of event files; the
    rest of the events' derivation must not change between folds (a new product
    dimension calls for a new path).
    """

    def __init__(self, spark: SparkSession, path: str, read: Callable[[list[str]], DataFrame]):
        self.spark, self.read_events = spark, read
        self.log = CommitLog(spark, f"{path}/manifest", MANIFEST_SCHEMA)
        self.partials = BucketedTable(f"{path}/partials", StructType.fromDDL(PARTIAL_SCHEMA), ("user_session",),
                                      session_buckets(spark), partition="version")

    def fold(self, source: str) -> int:
        """Fold the event files below ``source`` that aren't folded in yet; the
        number of them.  Files are immutable: if a folded one was rewritten or
        removed, everything is folded anew, as partials can't be taken back."""
        seen, manifest = self.log.latest()
        listed = {f.path: f for f in list_files(self.spark, source)}
        rows = [tuple(r) for r in manifest.collect()]      # one row per event file, as in the listing
        if any(r[0] not in listed or (r[1], r[2]) != (listed[r[0]].bytes, listed[r[0]].modified) for r in rows):
            rows = []
        known = {r[0] for r in rows}
        new = [f for path, f in sorted(listed.items()) if path not in known]
        if not new:
            return 0
        version, fold = uuid.uuid4().hex[:12], max((r[3] for r in rows), default=0) + 1
        counted = Observation()
        raw = self.read_events([f.path for f in new])
        raw = raw.observe(counted, F.count(F.lit(1)).alias("n_raw"),
                          F.count_if(F.col("user_id").isNotNull() & F.col("user_session").isNotNull()
                                     & F.col("event_type").isin("view", "cart", "purchase")).alias("n_clean"))
        self.partials.append(session_category_counts(clean_events(raw)).withColumn("version", F.lit(version)))
        n = observed_counts(counted, ["n_raw", "n_clean"])
        # counts are the fold's, on its first file's row
        rows += [(f.path, f.bytes, f.modified, fold, version, n["n_raw"] if i == 0 else 0, n["n_clean"] if i == 0 else 0)
                 for i, f in enumerate(new)]
        live = {r[4] for r in rows}
        if len(live) > MAX_VERSIONS:
            version = uuid.uuid4().hex[:12]
            self.partials.append(merged_partials(self._versions(live)).withColumn("version", F.lit(version)))
            rows = [(*r[:4], version, *r[5:]) for r in rows]
        self.log.commit(seen + 1, self.spark.createDataFrame(rows, MANIFEST_SCHEMA))
        return len(new)

    def _versions(self, live) -> DataFrame:
        return self.partials.read(self.spark).filter(F.col("version").isin(sorted(live)))

    def cells(self) -> DataFrame:
        """The partials of all folded files."""
        live = [r["version"] for r in self.folded().select("version").distinct().collect()]
        return self._versions(live).drop("version")

    def rollup(self) -> DataFrame:
        return rollup_of_partials(self.cells())

    def folded(self) -> DataFrame:
        """The manifest: files, the fold that read them, rows it read and kept."""
        return self.log.latest()[1]

    def vacuum(self) -> int:
        """Delete the partials of versions that no committed manifest uses; only
        when nobody folds or reads an older state."""
        live = {r["version"] for r in self.folded().select("version").distinct().collect()}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.partials.path)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        dead = [s.getPath() for s in (fs.listStatus(path) if fs.exists(path) else [])
                if s.getPath().getName().startswith("version=") and s.getPath().getName()[8:] not in live]
        for folder in dead:
            fs.delete(folder, True)
        return len(dead)
