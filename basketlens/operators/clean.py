"""Event cleaning and category extraction (row-local, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.columns import main_category, parse_event_time
from basketlens.schemas import EVENT_TYPES


def clean_events(raw: DataFrame) -> DataFrame:
    """B1 parse time (bad text -> NULL, row kept), B2 drop rows without user or
    session, B3 keep view / cart / purchase."""
    df = raw
    if isinstance(df.schema["event_time"].dataType, T.StringType):
        df = df.withColumn("event_time", F.to_timestamp_ntz(parse_event_time("event_time")))
    return (df.dropna(subset=["user_id", "user_session"])
              .filter(F.col("event_type").isin(*EVENT_TYPES)))


def observed_clean(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """The clean events and what was dropped on the way, counted by the pass that
    cleans them: no second scan.  The counts are there once an action on the frame
    has finished (``drop_reasons``); every raw row is in exactly one of kept,
    corrupt, no_user, no_session and other_type, tried in that order.
    """
    counted = Observation()
    corrupt = F.col("corrupt_record").isNotNull() if "corrupt_record" in raw.columns else F.lit(False)
    no_user = ~corrupt & F.col("user_id").isNull()
    no_session = ~corrupt & F.col("user_id").isNotNull() & F.col("user_session").isNull()
    has_ids = ~corrupt & F.col("user_id").isNotNull() & F.col("user_session").isNotNull()
    known = F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))
    kept = has_ids & known
    observed = raw.observe(
        counted, F.count(F.lit(1)).alias("raw"), F.count_if(corrupt).alias("corrupt"),
        F.count_if(no_user).alias("no_user"), F.count_if(no_session).alias("no_session"),
        F.count_if(has_ids & ~known).alias("other_type"), F.count_if(kept).alias("kept"),
        F.count_if(kept & F.col("category_code").isNull()).alias("kept_uncategorized"),
        F.count_if(kept & F.col("event_time").isNull()).alias("kept_untimed"),
        *(F.count_if(kept & (F.col("event_type") == t)).alias(f"kept_{t}") for t in EVENT_TYPES))
    return clean_events(observed.filter(~corrupt)), counted


REASONS = ["raw", "corrupt", "no_user", "no_session", "other_type", "kept", "kept_uncategorized", "kept_untimed",
           *(f"kept_{t}" for t in EVENT_TYPES)]


def observed_counts(counted: Observation, names: list[str]) -> dict[str, int]:
    """The counts of a finished pass.  Spark skips a pass that it finds to be empty,
    and its counts with it: those are 0."""
    row = counted._jo.getRow()
    return counted.get if row.length() else dict.fromkeys(names, 0)


def drop_reasons(counted: Observation) -> list[tuple[str, int]]:
    """(reason, rows) of a finished pass, by name."""
    return sorted(observed_counts(counted, REASONS).items())


def with_category_main(events: DataFrame) -> DataFrame:
    """B5 on every event: first path element, NULL when category_code is NULL."""
    return events.withColumn("category_main", main_category("category_code"))


def categorized_events(clean: DataFrame) -> DataFrame:
    """B4 + B5: events with a category, plus its first path element."""
    return with_category_main(clean.filter(F.col("category_code").isNotNull()))
