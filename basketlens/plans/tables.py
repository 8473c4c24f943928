"""Named intermediate tables of the batch chain, built lazily from a data dir.

raw events -> clean events -> session roll-up -> labeled / category sessions.
Each call builds a fresh logical plan; Catalyst prunes the columns each
consumer needs down to the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators.clean import clean_events
from basketlens.operators.sessions import labeled_sessions, session_features
from basketlens.sources.events import events_from_tables, load_events_csv


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw shop events from a source: ``csv:<path>`` (or a path ending in .csv)
    is the original's header CSV of events; anything else is a folder of the
    driver's tables, mapped by the adapter."""
    if sf_dir.startswith("csv:"):
        return load_events_csv(spark, sf_dir[4:])
    if sf_dir.rstrip("/").endswith(".csv"):
        return load_events_csv(spark, sf_dir)
    return events_from_tables(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(raw_events(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str, include_labels: bool = False) -> DataFrame:
    return session_features(clean(spark, sf_dir), include_labels=include_labels)


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labeled_sessions(clean(spark, sf_dir))


def rounded_price(df: DataFrame, places: int = 6) -> DataFrame:
    """avg_price at micro precision: doubles summed in a different order differ
    in the last bits; six places is the published precision of result tables."""
    return df.withColumn("avg_price", F.round("avg_price", places))
