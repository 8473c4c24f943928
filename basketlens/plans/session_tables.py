"""Stored session tables, bucketed and sorted by session, and the joins over them.

The clean events of a dataset are dealt once by (session, salt) -- a session too
large for one task has several salts, as in the unstored form -- and the first
purchases of the sessions likewise.  Their join then reads matching buckets side
by side: no exchange on either side, whatever the number of reports that follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators.sessions import (flagged_pre, purchase_labels, purchase_stats, rolled_up, rollup_labeled,
                                           salted_sides)
from basketlens.plans import tables, training
from basketlens.schemas import SESSION_FEATURE_COLUMNS
from basketlens.sources.sinks import materialized

KEYS = ("user_session", "_salt")


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, f"{training.workspace(spark, sf_dir)}/purchase_stats",
                        lambda: purchase_stats(tables.clean(spark, sf_dir)), bucketed_by=("user_session",))


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return salted_sides(tables.clean(spark, sf_dir), _stats(spark, sf_dir))


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events with their salt, bucketed by (session, salt)."""
    return materialized(spark, f"{training.workspace(spark, sf_dir)}/session_events",
                        lambda: _sides(spark, sf_dir)[0], bucketed_by=KEYS)


def first_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First purchase per (session, salt), bucketed like the events."""
    return materialized(spark, f"{training.workspace(spark, sf_dir)}/first_purchases",
                        lambda: _sides(spark, sf_dir)[1], bucketed_by=KEYS)


def pre_purchase_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labeled sessions with features from pre-purchase events only (Q4), from the
    stored sides: the one exchange left is the roll-up's, of partial rows."""
    return rollup_labeled(rolled_up(flagged_pre(session_events(spark, sf_dir), first_purchases(spark, sf_dir))))


def session_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase label per session over all its clean events, bucketed by session."""
    return materialized(spark, f"{training.workspace(spark, sf_dir)}/session_labels",
                        lambda: purchase_labels(tables.clean(spark, sf_dir)), bucketed_by=("user_session",))


def labeled_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 as a join of two stored tables, features and labels: no exchange at all."""
    features = training.stored_rollup(spark, sf_dir).filter("n_categorized > 0").select(*SESSION_FEATURE_COLUMNS)
    labels = session_labels(spark, sf_dir).select("user_session", F.col("label"))
    return features.join(labels, "user_session", "left").fillna(0)
