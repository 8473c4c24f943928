"""Event sources: raw shop-event CSV (A1), the driver's test tables (adapter),
samples (A2).

Everything returned is a lazy DataFrame; filters and projections applied
later reach the Parquet scan (PushedFilters / ReadSchema).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.columns import parse_event_time, sample_sessions_flag
from basketlens.schemas import (PRODUCT_SCHEMA, RAW_EVENT_CSV_SCHEMA, SAMPLE_FRACTION,
                                SAMPLE_SEED, TABLE_SCHEMAS)
from basketlens.session import int_setting
from basketlens.sources.sinks import dataset_workspace, materialized


def load_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1: header CSV of raw shop events (no type-inference pass).

    Columns are matched by the header's names, in whatever order it has them;
    columns it lacks are NULL, others are ignored, and a file whose header
    differs from the first one's is an error.  Every column arrives as text, as
    in the source file; types are applied here with ``try_`` casts so one bad
    field nulls that field, not the job.  A line that is not a record of this
    header is kept in ``corrupt_record``.  An ``event_id`` is added for
    deterministic tie-breaks.
    """
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names]
                          + [T.StructField("corrupt_record", T.StringType())])
    raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt_record")
           .option("columnPruning", False)       # whether a line is a record shows in all its fields
           .csv(path))
    absent = {c: F.lit(None).cast("string") for c in RAW_EVENT_CSV_SCHEMA.fieldNames() if c not in names}
    return raw.withColumns(absent).select(
        F.monotonically_increasing_id().alias("event_id"),
        F.to_timestamp_ntz(parse_event_time("event_time")).alias("event_time"),
        "event_type",
        F.col("product_id").try_cast("int").alias("product_id"),
        "category_code",
        F.col("price").try_cast("double").alias("price"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        "user_session", "corrupt_record",
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; declared schema where known (no inference job per read)."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Largest product dimension shipped to every task as a broadcast (estimated
# hashed size); a bigger one is joined with a shuffle join instead.  Default;
# a cluster may set spark.basketlens.maxBroadcastProductBytes.
MAX_BROADCAST_PRODUCT_BYTES = 64 * 1024 * 1024
_BROADCAST_DECISIONS: dict[str, bool] = {}


def _product_key():
    return F.get_json_object("props", "$.k").cast("int")


def product_categories(part: DataFrame) -> DataFrame:
    """Product dimension of the test data: p_partkey -> dotted category path."""
    return part.select(
        F.col("p_partkey").alias("product_key"),
        F.concat(F.lower("p_type"), F.lit("."), F.replace("p_name", F.lit(" "), F.lit("_")))
        .alias("product_category"))


def referenced_products(ev: DataFrame, part: DataFrame) -> DataFrame:
    """The product dimension reduced to the products the events reference.

    The distinct product keys of the events are one pruned column with a
    partial aggregate (at most one row per product per task reaches the
    shuffle); the dimension is then left-semi joined with them.  The result
    grows with the catalogue in use, not with the event log.
    """
    keys = (ev.select(_product_key().cast("bigint").alias("product_key"))
              .filter(F.col("product_key").isNotNull()).distinct())
    return product_categories(part).join(keys, "product_key", "left_semi")


def broadcastable(products: DataFrame, cache_key: str | None = None,
                  max_bytes: int | None = None) -> bool:
    """Size check before a broadcast: one aggregate over the (written, small)
    dimension estimates its hashed size -- 8-byte key, string bytes, ~32 bytes
    of per-row overhead -- against ``max_bytes``."""
    if cache_key is not None and cache_key in _BROADCAST_DECISIONS:
        return _BROADCAST_DECISIONS[cache_key]
    if max_bytes is None:
        max_bytes = int_setting(products.sparkSession, "spark.basketlens.maxBroadcastProductBytes",
                                MAX_BROADCAST_PRODUCT_BYTES)
    est = products.agg(
        (F.count(F.lit(1)) * 40 + F.coalesce(F.sum(F.octet_length("product_category")), F.lit(0)))
        .alias("bytes")).first()["bytes"]
    ok = est <= max_bytes
    if cache_key is not None:
        _BROADCAST_DECISIONS[cache_key] = ok
    return ok


def events_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map the driver's ``events`` + ``part`` tables onto raw shop events.

    event_type click -> cart; product = props.k; category = lower(p_type) '.'
    p_name (NULL for every tenth product); session = user-day (NULL for the
    products k % 25 = 7).

    The product join never shuffles the event log when the products in use
    are few: the referenced products are written once per dataset, their
    size is checked, and only then are they broadcast.  Beyond the bound the
    join is a plain shuffle join (AQE splits hot product keys).
    """
    ev = read_table(spark, sf_dir, "events")
    path = f"{dataset_workspace(spark, sf_dir)}/referenced_products"
    products = materialized(spark, path,
                            lambda: referenced_products(ev, read_table(spark, sf_dir, "part")),
                            schema=PRODUCT_SCHEMA)
    return adapt_events(ev, products, broadcast=broadcastable(products, cache_key=path))


def adapt_events(ev: DataFrame, products: DataFrame, broadcast: bool = False) -> DataFrame:
    """The adapter on given frames: ``products`` is a product dimension
    (``product_categories``); ``ev`` may be a streaming DataFrame (the product
    join is then a stream-static left join).  ``broadcast`` only after a
    size check (``broadcastable``)."""
    k = _product_key()
    staged = ev.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "click", F.lit("cart"))
         .otherwise(F.col("event_type")).alias("event_type"),
        k.alias("product_id"),
        F.col("value").alias("price"),
        "user_id",
        F.when(k % 25 == 7, F.lit(None).cast("string"))
         .otherwise(F.concat_ws("-", F.col("user_id").cast("string"),
                                F.date_format("ts", "yyyyMMdd"))).alias("user_session"),
    )
    side = F.broadcast(products) if broadcast else products
    joined = staged.join(side, staged.product_id == side.product_key, "left")
    return joined.select(
        "event_id", "event_time", "event_type", "product_id",
        F.when(F.col("product_id") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("product_category")).alias("category_code"),
        "price", "user_id",
        F.when(F.col("user_id").isNotNull(), F.col("user_session")).alias("user_session"),
    )


def sample_rows(df: DataFrame, fraction: float = SAMPLE_FRACTION,
                seed: int = SAMPLE_SEED) -> DataFrame:
    """A2 as written: Bernoulli row sample without replacement (splits sessions)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_sessions(df: DataFrame, per_mille: int = int(SAMPLE_FRACTION * 1000),
                    key: str = "user_session") -> DataFrame:
    """A2, session-preserving: keep every event of ~per_mille/1000 of the sessions.

    A pure per-row predicate on a hash of the key: no shuffle, independent of
    partitioning, and a session is either whole or absent.
    """
    return df.filter(sample_sessions_flag(key, per_mille))


def stream_events_from_tables(spark: SparkSession, sf_dir: str,
                              max_files_per_trigger: int | None = None) -> DataFrame:
    """The event table as a stream (file source over its Parquet path), mapped
    onto raw shop events like the batch adapter."""
    base = sf_dir.rstrip("/")
    schema = TABLE_SCHEMAS["events"]
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # a glob: the file source watches a folder, and this table is one file in it
    # products a future event may name are unknown: the whole dimension, size-checked
    products = product_categories(read_table(spark, sf_dir, "part"))
    return adapt_events(r.parquet(f"{base}/events*.parquet"), products,
                        broadcast=broadcastable(products, cache_key=f"part:{dataset_workspace(spark, sf_dir)}"))


def read_scored_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Read the scored-session table back; a store-assigned id is dropped."""
    return spark.read.parquet(path).drop("_id")
