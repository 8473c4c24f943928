"""Batch training chain: session tables -> hash split -> grid search -> runs.

Session tables are written once to the shared scratch folder and re-read:
that cuts the lineage (a lost executor re-reads Parquet instead of
re-aggregating the events) and every fit of a grid scans the small session
table, not the event log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators import models
from basketlens.operators.features import fit_category_labels, split_train_test
from basketlens.operators.sessions import rollup_features, rollup_labeled, session_rollup
from basketlens.plans import tables
from basketlens.sources.sinks import dataset_workspace, materialized
from basketlens.streaming.serving import ServedModel


def workspace(spark: SparkSession, sf_dir: str) -> str:
    """Stable per-dataset folder under the shared scratch root."""
    return dataset_workspace(spark, sf_dir)


def stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session roll-up with both labels, written once: one pass over the events
    serves both tasks.  Bucketed by session: a join or aggregate on the session
    reads it without an exchange."""
    return materialized(spark, f"{workspace(spark, sf_dir)}/session_rollup",
                        lambda: session_rollup(tables.clean(spark, sf_dir)), bucketed_by=("user_session",))


def intent_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labeled sessions (T3 input)."""
    return rollup_labeled(stored_rollup(spark, sf_dir))


def category_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with a purchased category (T4 input)."""
    return rollup_features(stored_rollup(spark, sf_dir), include_labels=True)


def runs_path(spark: SparkSession, sf_dir: str) -> str:
    return f"{workspace(spark, sf_dir)}/runs"


def model_root(spark: SparkSession, sf_dir: str) -> str:
    return f"{workspace(spark, sf_dir)}/models"


def train(spark: SparkSession, sf_dir: str, task: str,
          grids: dict[str, list[tuple]] | None = None) -> DataFrame:
    """Run (or resume) a task's grid search, all of its points unless ``grids``
    says otherwise; returns that task's runs (of this data: the workspace
    changes with it)."""
    labels = None
    if task == "intent":
        data, grids = intent_sessions(spark, sf_dir), grids or models.INTENT_GRIDS
    else:
        data, grids = category_sessions(spark, sf_dir), grids or models.CATEGORY_GRIDS
        indexer = fit_category_labels(data)     # one distributed count per category
        labels, data = list(indexer.labels), indexer.transform(data)
    tr, te = split_train_test(data)
    runs, root = runs_path(spark, sf_dir), model_root(spark, sf_dir)
    if models.pending_grid(spark, task, grids, runs).isEmpty():
        return models.read_runs(spark, runs).filter(F.col("task") == task)
    # index and vectors come from all sessions, the classifiers from the train split
    features = models.feature_pipeline(task).fit(data)
    return models.grid_search(spark, task, grids, tr, te, runs, root, labels, features)


def best_pipeline(spark: SparkSession, sf_dir: str, task: str,
                  grids: dict[str, list[tuple]] | None = None):
    """Train what is pending, then load the best run's fitted pipeline."""
    runs = train(spark, sf_dir, task, grids)
    row = models.best_model(runs, task).first()
    return models.load_run_model(row), row


def choose_model(spark: SparkSession, sf_dir: str, task: str, model: str | None = None,
                 point: tuple | None = None):
    """K9: the pipeline to serve -- the run of ``model`` with the given typed
    params when asked for (E8), else the best run of the task (C17 / F3).
    Returns (PipelineModel, run row); raises when the asked-for run is absent."""
    runs = models.read_runs(spark, runs_path(spark, sf_dir))
    if model is not None and point is not None:
        row = (models.runs_with_params(runs, task, model, point)
               .orderBy(F.col("trained_at").desc()).first())
        if row is None:
            raise LookupError(f"no {task} run of {model} with params {point}")
    else:
        row = models.best_model(runs, task).first()
        if row is None:
            raise LookupError(f"no {task} runs yet: train first")
    return models.load_run_model(row), row


def served(spark: SparkSession, sf_dir: str, task: str) -> ServedModel:
    """K9 while streams run: the pointer to the run that following streams serve."""
    return ServedModel(spark, f"{workspace(spark, sf_dir)}/serving/{task}")
