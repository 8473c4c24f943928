"""Declared schemas (T1-T9) and the fixed values the engine's semantics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the original behaviour for equal results)
# ---------------------------------------------------------------------------
EVENT_TYPES = ["view", "cart", "purchase"]          # kept by cleaning
UNKNOWN_CATEGORY = "unknown"                       # fill for a missing main category
CATEGORY_SEPARATOR = "."                           # category_code is a dotted path
FUNNEL_STAGES = ["Viewed", "Cart Add", "Purchased"]
TRAIN_FRACTION_TENTHS = 8                          # 80 / 20 split
SAMPLE_FRACTION = 0.025                            # 2.5 % sample, seed 42
SAMPLE_SEED = 42
PREDICTION_BINS = 30
PRICE_BINS = 40
DURATION_LIMIT_SECONDS = 5000
MESSAGE_DEFAULTS = {                               # stream fields missing from a message
    "num_views": 0.0,
    "num_cart_adds": 0.0,
    "avg_price": 0.0,
    "session_duration": 0.0,
    "num_purchases": 0.0,
    "unique_categories": 1.0,
}

# model-1 numeric inputs, in vector order (one-hot of main_category follows)
INTENT_NUMERIC_FEATURES = ["num_views", "num_cart_adds", "session_duration",
                           "avg_price", "unique_categories"]
# model-2 inputs, in vector order
CATEGORY_FEATURES = ["num_views", "num_cart_adds", "num_purchases", "avg_price",
                     "session_duration", "unique_categories"]
# columns kept by the scored-session sink, in order, when present
SCORED_COLUMNS = ["user_session", "num_views", "num_cart_adds", "label", "prediction",
                  "purchase_prob", "session_duration", "avg_price", "main_category",
                  "main_category_index", "unique_categories"]

# ---------------------------------------------------------------------------
# T1 raw events
# ---------------------------------------------------------------------------
RAW_EVENT_CSV_SCHEMA = T.StructType([                # as the file holds it: text
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("user_session", T.StringType()),
])


# The driver's test tables, columns as read (declared, so a read runs no
# schema-inference job; only these columns are scanned)
EVENTS_TABLE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
PART_TABLE_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()),
    T.StructField("p_name", T.StringType()),
    T.StructField("p_type", T.StringType()),
])
PRODUCT_SCHEMA = T.StructType([                      # the adapter's product dimension
    T.StructField("product_key", T.LongType()),
    T.StructField("product_category", T.StringType()),
])
TABLE_SCHEMAS = {"events": EVENTS_TABLE_SCHEMA, "part": PART_TABLE_SCHEMA}

# ---------------------------------------------------------------------------
# T2 session features (+ label_category), T8 stream message
# ---------------------------------------------------------------------------
SESSION_FEATURE_COLUMNS = ["user_session", "num_views", "num_cart_adds", "num_purchases",
                           "session_start", "session_end", "avg_price", "session_duration",
                           "main_category", "unique_categories"]

SESSION_MESSAGE_SCHEMA = T.StructType([
    T.StructField("user_session", T.StringType()),
    T.StructField("num_views", T.LongType()),
    T.StructField("num_cart_adds", T.LongType()),
    T.StructField("num_purchases", T.LongType()),
    T.StructField("session_start", T.TimestampNTZType()),   # shop wall-clock time
    T.StructField("session_end", T.TimestampNTZType()),
    T.StructField("avg_price", T.DoubleType()),
    T.StructField("session_duration", T.LongType()),
    T.StructField("main_category", T.StringType()),
    T.StructField("unique_categories", T.LongType()),
    T.StructField("label_category", T.StringType()),
])

# ---------------------------------------------------------------------------
# T6 runs table (one row per fitted grid point)
# ---------------------------------------------------------------------------
RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("task", T.StringType()),          # intent | category
    T.StructField("model", T.StringType()),         # rf lr dt nb gbt
    T.StructField("params", T.StringType()),        # display key, "_"-joined
    T.StructField("param_map", T.MapType(T.StringType(), T.StringType())),   # canonical values
    T.StructField("model_params", T.StringType()),  # JSON: every param of the fitted estimator
    T.StructField("auc", T.DoubleType()),
    T.StructField("pr_auc", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("trained_at", T.TimestampType()),
])
