"""Shared pieces of the registered queries (model choice for scoring)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from basketlens.plans import training


def best_models(spark: SparkSession, sf_dir: str):
    """K9: the best intent and category pipelines of the whole grids (resumed
    from the runs table when already trained)."""
    intent, _ = training.best_pipeline(spark, sf_dir, "intent")
    category, _ = training.best_pipeline(spark, sf_dir, "category")
    return intent, category
