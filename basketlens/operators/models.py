"""Grid search over MLlib classifiers with a
runs table.

One generic ``grid_search`` serves all model kinds.  The runs
table (Parquet, append-only) is the resume log: grid points already present
are skipped with an anti join (E7), each finished fit appends one row (G1)
and its fitted ``PipelineModel`` -- feature stages included -- is saved under
the run id (A13).  Points are claimed one by one through the shared folder, so
several applications share a grid and none fits a point twice.  Model picks are
plain aggregates over the table.

Training itself is MLlib's: tree learners aggregate split statistics per
partition (treeAggregate) and LR runs distributed L-BFGS/OWL-QN, so a fit is
a sequence of Spark jobs over the cached training frame.
"""

from __future__ import annotations

import queue
import time
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassificationModel, GBTClassifier,
                                       LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pyspark.ml.feature import IndexToString

from basketlens.operators.claims import LEASE_SECONDS, Claims
from basketlens.operators.features import category_feature_stages, intent_feature_stages
from basketlens.schemas import RUNS_SCHEMA
from basketlens.session import merges_by_cores, merges_by_partitions, scratch_root
from basketlens.sources.sinks import is_missing

# ---------------------------------------------------------------------------
# The parameter grids of the original grid searches
# ---------------------------------------------------------------------------
INTENT_GRIDS: dict[str, list[tuple]] = {
    # (numTrees, maxDepth, maxBins)
    "rf": [(50, 5, 32), (100, 5, 32), (50, 10, 32), (100, 10, 32), (100, 5, 64), (200, 20, 64)],
    # (maxIter, regParam, elasticNetParam)
    "lr": [(50, 0.0, 0.0), (100, 0.1, 0.0), (100, 0.01, 0.5), (200, 0.01, 1.0)],
    # (maxDepth, maxBins)
    "dt": [(5, 32), (10, 32), (20, 32), (5, 64), (10, 64)],
    # (smoothing, modelType)
    "nb": [(1.0, "multinomial"), (0.5, "multinomial"), (2.0, "multinomial")],
    # (maxIter, maxDepth, maxBins)
    "gbt": [(50, 5, 32), (100, 5, 32), (50, 10, 64), (100, 10, 64)],
}
CATEGORY_GRIDS: dict[str, list[tuple]] = {
    "rf": [(50, 5), (100, 10)],      # (numTrees, maxDepth)
    "lr": [(50,), (100,)],           # (maxIter,)
    "dt": [(5,), (10,)],             # (maxDepth,)
}
PARAM_NAMES: dict[tuple[str, str], list[str]] = {
    ("intent", "rf"): ["numTrees", "maxDepth", "maxBins"],
    ("intent", "lr"): ["maxIter", "regParam", "elasticNetParam"],
    ("intent", "dt"): ["maxDepth", "maxBins"],
    ("intent", "nb"): ["smoothing", "modelType"],
    ("intent", "gbt"): ["maxIter", "maxDepth", "maxBins"],
    ("category", "rf"): ["numTrees", "maxDepth"],
    ("category", "lr"): ["maxIter"],
    ("category", "dt"): ["maxDepth"],
}
SEED = 42
# fits that run at once: each is a chain of small jobs over the persisted vectors
PARALLEL_FITS = 6
# seconds between looks at the runs table while other applications fit the last points
POLL_SECONDS = 2.0

_ESTIMATORS: dict[str, Callable] = {
    "rf": RandomForestClassifier,
    "lr": LogisticRegression,
    "dt": DecisionTreeClassifier,
    "nb": NaiveBayes,
    "gbt": GBTClassifier,
}


def params_key(point: Sequence) -> str:
    """Display key of a grid point: values joined with '_'."""
    return "_".join(str(v) for v in point)


def param_map(task: str, model: str, point: Sequence) -> dict[str, str]:
    """Named params in canonical text: 100, 100.0 and 1e2 are the same number."""
    return {n: str(v) if isinstance(v, (str, bool)) else repr(float(v))
            for n, v in zip(PARAM_NAMES.get((task, model), [f"p{i}" for i in range(len(point))]), point)}


def _map_text(params: dict[str, str]) -> str:
    return ",".join(sorted(f"{k}={v}" for k, v in params.items()))


def _map_text_column() -> Column:
    pairs = F.transform(F.map_entries("param_map"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), ",")


def make_estimator(task: str, model: str, point: Sequence):
    kwargs = dict(zip(PARAM_NAMES[(task, model)], point))
    if model in ("rf", "dt", "gbt"):
        kwargs["seed"] = SEED
    if model in ("rf", "dt"):
        # each row keeps the node it is in: else every task of every pass gets the whole forest grown so far
        kwargs["cacheNodeIds"] = True
    return _ESTIMATORS[model](featuresCol="features", labelCol="label", **kwargs)


def fit_frame(vectors: DataFrame) -> DataFrame:
    """The two columns that fits read, with the frame's rows and partitions, persisted.

    A fit is hundreds to thousands of small jobs, and every task of theirs gets the
    whole lineage back to the session table; the checkpoint cuts it.  It is made from
    persisted rows: those keep the partitions of a bucketed table, whatever the plan."""
    scratch_root(vectors.sparkSession)       # checkpoint folder: the cluster's, else a default
    rows = vectors.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return rows.checkpoint().persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        rows.unpersist()


def feature_pipeline(task: str) -> Pipeline:
    return Pipeline(stages=intent_feature_stages() if task == "intent" else category_feature_stages())


def served_pipeline(task: str, features: PipelineModel, fitted, labels: Sequence[str] | None) -> PipelineModel:
    """Fitted feature stages + classifier (+ for categories: index -> class name)."""
    names = [] if task == "intent" else [IndexToString(
        inputCol="prediction", outputCol="predicted_category", labels=list(labels or []))]
    return PipelineModel([*features.stages, fitted, *names])


def evaluate(task: str, predictions: DataFrame) -> dict[str, float | None]:
    """J7 / J8 / J9 with MLlib's evaluators (distributed); every distinct score is
    a threshold (numBins 0), so the areas are exact at any size."""
    if task == "intent":
        both = BinaryClassificationEvaluator(labelCol="label", numBins=0)
        both._transfer_params_to_java()
        # the rows are scored, counted and sorted once: each evaluation of the evaluator does all that anew
        curve = both._java_obj.getMetrics(predictions.select("rawPrediction", "label")._jdf)
        try:
            return {"auc": curve.areaUnderROC(), "pr_auc": curve.areaUnderPR(), "accuracy": None}
        finally:
            curve.unpersist()
    acc = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                            metricName="accuracy")
    return {"auc": None, "pr_auc": None, "accuracy": acc.evaluate(predictions)}


def read_runs(spark: SparkSession, runs_path: str) -> DataFrame:
    """The runs table, or an empty one with the declared schema if there is none."""
    try:
        return spark.read.schema(RUNS_SCHEMA).parquet(runs_path).select(*RUNS_SCHEMA.fieldNames())
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return spark.createDataFrame([], RUNS_SCHEMA)


def grid_frame(spark: SparkSession, task: str, grids: dict[str, list[tuple]]) -> DataFrame:
    rows = [(task, m, params_key(p), i, _map_text(param_map(task, m, p)))
            for m, pts in grids.items() for i, p in enumerate(pts)]
    return spark.createDataFrame(rows, "task string, model string, params string, grid_pos int, typed string")


def pending_grid(spark: SparkSession, task: str, grids: dict[str, list[tuple]],
                 runs_path: str) -> DataFrame:
    """Grid points not yet in the runs table (left anti join on typed params)."""
    done = read_runs(spark, runs_path).select("task", "model", _map_text_column().alias("typed"))
    return grid_frame(spark, task, grids).join(done, ["task", "model", "typed"], "left_anti").drop("typed")


def one_fit(points: Sequence[tuple[str, tuple]]) -> list[list[tuple[str, tuple]]]:
    """The points dealt into groups that one fit serves, the longest of a group last.

    Boosting adds tree after tree: a fit of fewer iterations, all else equal, has the
    first trees of the longer one."""
    groups: dict[tuple, list[tuple[str, tuple]]] = {}
    for model, point in points:
        groups.setdefault((model, point[1:] if model == "gbt" else point), []).append((model, point))
    return [sorted(g, key=lambda x: x[1][0]) if len(g) > 1 else g for g in groups.values()]


def shorter_fit(estimator: GBTClassifier, longer: GBTClassificationModel) -> GBTClassificationModel:
    """What ``estimator`` fits where the same estimator with more iterations fitted ``longer``."""
    n, java, sc = estimator.getMaxIter(), longer._java_obj, SparkContext._active_spark_context
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = sc._gateway.new_array(sc._jvm.double, n)
    for i, (tree, weight) in enumerate(zip(list(java.trees())[:n], list(java.treeWeights())[:n])):
        trees[i], weights[i] = tree, weight
    model = GBTClassificationModel(sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        estimator.uid, trees, weights, java.numFeatures(), java.numClasses()))
    return estimator._copyValues(model)


def _pending_points(spark, task, grids, runs_path) -> list[tuple[str, tuple]]:
    pend = {(r["model"], r["grid_pos"]) for r in pending_grid(spark, task, grids, runs_path).collect()}
    todo = [(m, p) for m, points in grids.items() for i, p in enumerate(points) if (m, i) in pend]
    # the slowest kinds first, so that they don't come last alone
    return sorted(todo, key=lambda x: ("gbt", "rf", "lr", "dt", "nb").index(x[0]))


def grid_search(spark: SparkSession, task: str, grids: dict[str, list[tuple]],
                train: DataFrame, test: DataFrame, runs_path: str, model_root: str,
                labels: Sequence[str] | None = None, features: PipelineModel | None = None,
                parallel: int = PARALLEL_FITS, lease: float = LEASE_SECONDS) -> DataFrame:
    """Fit every pending grid point, append one run row per fit, save each
    fitted pipeline; return the runs rows of this task.

    The feature stages (``features``, else fitted on ``train``) run once; the
    classifiers are fitted on their persisted vectors, ``parallel`` at a time.
    The loop is over model configurations (a fixed, small list); every fit and
    evaluation inside it is a distributed Spark job.  For the category task the
    frames carry the class index ``label`` and ``labels`` names the classes in
    index order.

    Applications that search the same grid at once share it: a point is fitted by
    whoever claims it, the others wait for its row.  The points of an application
    that died become free after ``lease`` seconds.  Boosted points that differ only in
    their iterations are one fit: each has its own row and saved pipeline.
    """
    if not _pending_points(spark, task, grids, runs_path):
        return read_runs(spark, runs_path).filter(F.col("task") == task)
    features = features or feature_pipeline(task).fit(train)
    train, test = (fit_frame(features.transform(x)) for x in (train, test))

    def log(model: str, point: tuple, fitted) -> None:
        run_id = f"{task}-{model}-{params_key(point)}-{uuid.uuid4().hex[:8]}"
        path = f"{model_root}/{run_id}"
        served_pipeline(task, features, fitted, labels).write().overwrite().save(path)
        # what is evaluated is what was saved: the saved model has no training summary, which holds
        # the session, and a session that has observed metrics can't go to the tasks
        pipeline = PipelineModel.load(path)
        with merges_by_partitions(spark):        # the scores are as many as the rows
            metrics = evaluate(task, pipeline.stages[len(features.stages)].transform(test))
        row = spark.createDataFrame(
            [(run_id, task, model, params_key(point), param_map(task, model, point),
              estimator_params_json(pipeline), metrics["auc"], metrics["pr_auc"], metrics["accuracy"], path)],
            "run_id string, task string, model string, params string, "
            "param_map map<string,string>, model_params string, auc double, "
            "pr_auc double, accuracy double, model_path string")
        append_run(row.withColumn("trained_at", F.current_timestamp()), runs_path)

    def work(groups: queue.SimpleQueue, claims: Claims) -> int:
        """Fit the points of the queue that nobody else holds; how many."""
        fits = 0
        while True:
            try:
                group = groups.get_nowait()
            except queue.Empty:
                return fits
            held = {}
            try:
                for model, point in group:
                    claim = claims.take(f"{task}|{model}|{_map_text(param_map(task, model, point))}")
                    if claim is not None:
                        held[model, point] = claim
                # rows may have come between the look at the table and the claims
                due = _pending_points(spark, task, {group[0][0]: [p for _, p in held]}, runs_path)
                longest = make_estimator(task, *due[-1]).fit(train) if due else None
                for model, point in due:
                    log(model, point, longest if (model, point) == due[-1]
                        else shorter_fit(make_estimator(task, model, point), longest))
                    claims.drop(held.pop((model, point)), True)
                    fits += 1
                while held:
                    claims.drop(held.popitem()[1], True)
            finally:
                for claim in held.values():
                    claims.drop(claim, False)

    try:
        train.count(), test.count()
        with merges_by_cores(spark), Claims(spark, f"{runs_path.rstrip('/')}-claims", lease) as claims:
            while todo := _pending_points(spark, task, grids, runs_path):
                groups: queue.SimpleQueue = queue.SimpleQueue()
                for x in one_fit(todo):
                    groups.put(x)
                threads = max(1, min(parallel, groups.qsize()))
                with ThreadPool(threads) as pool:
                    fits = pool.map(inheritable_thread_target(lambda _: work(groups, claims)), range(threads))
                if not sum(fits):
                    time.sleep(POLL_SECONDS)         # others hold what is left
    finally:
        train.unpersist()
        test.unpersist()
    return read_runs(spark, runs_path).filter(F.col("task") == task)


def estimator_params_json(fitted: PipelineModel) -> str:
    """Every parameter of the fitted classifier stage, as JSON text."""
    import json
    est = next(st for st in reversed(fitted.stages) if hasattr(st, "extractParamMap")
               and type(st).__name__.endswith("Model"))
    return json.dumps({p.name: v for p, v in est.extractParamMap().items()},
                      sort_keys=True, default=str)


def append_run(row: DataFrame, runs_path: str) -> None:
    """G1: append result rows to the runs table.  Each append has a folder of its
    own: jobs of two applications that append to one folder would clear away each
    other's temporary files."""
    row.select(*RUNS_SCHEMA.fieldNames()).write.parquet(f"{runs_path}/batch={uuid.uuid4().hex}")


def _metric(task: str) -> str:
    return "auc" if task == "intent" else "accuracy"


def best_grid_row(runs: DataFrame) -> DataFrame:
    """Per (task, model) the best run; ties -> first trained."""
    m = F.when(F.col("task") == "intent", F.col("auc")).otherwise(F.col("accuracy"))
    w = Window.partitionBy("task", "model").orderBy(m.desc_nulls_last(), "trained_at", "run_id")
    return runs.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def best_model(runs: DataFrame, task: str = "intent") -> DataFrame:
    """The single best run of a task (metric desc, then model,
    params: an explicit, stable tie order)."""
    m = _metric(task)
    return (runs.filter(F.col("task") == task)
                .orderBy(F.col(m).desc_nulls_last(), "model", "params", "run_id")
                .limit(1))


def model_scores(runs: DataFrame, task: str = "intent") -> DataFrame:
    """One row per model kind with its best run's scores."""
    best = best_grid_row(runs.filter(F.col("task") == task))
    return best.select("model", "params", "auc", "pr_auc", "accuracy").orderBy("model")


def best_per_model(runs: DataFrame, task: str = "category") -> DataFrame:
    """Best metric per model kind."""
    m = _metric(task)
    return (runs.filter(F.col("task") == task).groupBy("model")
                .agg(F.max(m).alias(f"max_{m}")).orderBy("model"))


def runs_with_params(runs: DataFrame, task: str, model: str, point: Sequence) -> DataFrame:
    """Runs of a model whose typed params equal a given point."""
    return runs.filter((F.col("task") == task) & (F.col("model") == model)
                       & (_map_text_column() == _map_text(param_map(task, model, point))))


def load_run_model(runs_row) -> PipelineModel:
    """Load the fitted pipeline of a run row."""
    return PipelineModel.load(runs_row["model_path"])
