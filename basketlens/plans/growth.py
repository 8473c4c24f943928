"""Datasets that grow by files, and counts taken while cleaning.

The given event table is appended to a folder in three steps; the incremental
roll-up folds after each one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators.clean import drop_reasons, observed_clean
from basketlens.operators.incremental import IncrementalRollup
from basketlens.plans import tables
from basketlens.schemas import RAW_EVENT_CSV_SCHEMA, TABLE_SCHEMAS
from basketlens.session import scratch_path
from basketlens.sources.events import adapt_events, broadcastable, product_categories, read_table
from basketlens.sources.sinks import dataset_workspace, write_table

APPENDS = 3


def rollup_of(spark: SparkSession, sf_dir: str, path: str) -> IncrementalRollup:
    """An incremental roll-up under ``path`` of event files like the given table's."""
    products = product_categories(read_table(spark, sf_dir, "part"))
    # products that later files name are unknown: the whole dimension, size-checked
    small = broadcastable(products, cache_key=f"part:{dataset_workspace(spark, sf_dir)}")

    def read(files: list[str]) -> DataFrame:
        return adapt_events(spark.read.schema(TABLE_SCHEMAS["events"]).parquet(*files), products, broadcast=small)

    return IncrementalRollup(spark, path, read)


def grown_rollup(spark: SparkSession, sf_dir: str) -> IncrementalRollup:
    """The events appended in three parts, folded after each; every session has
    events in several parts."""
    base = scratch_path(spark, "incremental")
    rollup = rollup_of(spark, sf_dir, f"{base}/rollup")
    events = read_table(spark, sf_dir, "events")
    for i in range(APPENDS):
        events.filter(F.col("event_id") % APPENDS == i).write.mode("append").parquet(f"{base}/events")
        rollup.fold(f"{base}/events")
    return rollup


def clean_and_count(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """(reason, n): the clean events are written, their counts come with that pass."""
    clean, counted = observed_clean(raw)
    write_table(clean, scratch_path(spark, "clean_events"), source_paths=[])
    return spark.createDataFrame(drop_reasons(counted), "reason string, n long")


def csv_with_foreign_lines(spark: SparkSession, sf_dir: str) -> str:
    """A glob of CSV files: the raw events as text records, and every hundredth
    event's ``props`` as a line of its own, which is no record of the header."""
    names = RAW_EVENT_CSV_SCHEMA.fieldNames()
    raw = tables.raw_events(spark, sf_dir)
    fields = F.struct(*((F.col(c) if c in raw.columns else F.lit(None)).cast("string").alias(c) for c in names))
    parts = 8
    part = F.pmod(F.xxhash64("line"), F.lit(parts)).alias("part")
    records = raw.select(F.to_csv(fields).alias("line"))
    foreign = read_table(spark, sf_dir, "events").filter("event_id % 100 = 0").select(F.col("props").alias("line"))
    lines = records.unionByName(foreign).select(part, F.lit(1).alias("rank"), "line")
    headers = spark.range(parts).select(F.col("id").alias("part"), F.lit(0).alias("rank"), F.lit(",".join(names)).alias("line"))
    path = scratch_path(spark, "events_csv")
    (lines.unionByName(headers).repartition("part").sortWithinPartitions("part", "rank").select("part", "line")
     .write.partitionBy("part").text(path))
    return f"{path}/part=*"
