"""Feature pipeline, split, label maps, grid search + runs table, scoring."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketlens.functions.columns import top_k_indices
from basketlens.operators import models
from basketlens.operators.evaluation import exact_auc
from basketlens.operators.features import (fit_category_labels, fit_intent_features, label_map,
                                           split_train_test)
from basketlens.operators.scoring import purchase_uplift, score_category, score_intent
from basketlens.plans import tables
from conftest import SF_SMALL


def test_split_disjoint_total_stable(spark):
    lab = tables.labeled(spark, SF_SMALL)
    tr, te = split_train_test(lab)
    assert tr.count() + te.count() == lab.count()
    assert tr.join(te, "user_session").count() == 0
    tr2, _ = split_train_test(lab.repartition(7))
    assert tr.select("user_session").exceptAll(tr2.select("user_session")).count() == 0
    assert (tr.count(), te.count()) == (248, 51)


def test_label_map_frequency_then_alpha(spark):
    df = spark.createDataFrame([("x",), ("b",), ("b",), ("a",), ("x",), ("c",)], "label_category string")
    rows = label_map(spark, fit_category_labels(df)).collect()
    assert [(r["index"], r["category"]) for r in rows] == [(0, "b"), (1, "x"), (2, "a"), (3, "c")]


def test_onehot_unseen_category_is_all_zero(spark):
    lab = tables.labeled(spark, SF_SMALL)
    fitted = fit_intent_features(lab)
    n = len(fitted.stages[1].labels)
    probe = lab.limit(1).withColumn("main_category", F.lit("never-seen"))
    arr = fitted.transform(probe).select(vector_to_array("main_category_ohe").alias("a")).first()["a"]
    assert len(arr) == n and sum(arr) == 0.0
    known = fitted.transform(lab.limit(5)).select(vector_to_array("main_category_ohe").alias("a")).collect()
    assert all(len(r["a"]) == n and sum(r["a"]) == 1.0 for r in known)


def test_top_k_indices(spark):
    df = spark.createDataFrame([([0.1, 0.5, 0.2, 0.2],), ([0.3, 0.3, 0.4],)], "p array<double>")
    got = [r["t"] for r in df.select(top_k_indices("p", 3).alias("t")).collect()]
    assert got == [[1, 2, 3], [2, 0, 1]]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=2, max_size=40))
def test_exact_auc_matches_brute_force(spark, rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    df = spark.createDataFrame(rows, "score int, label int")
    got = exact_auc(df, "score").first()["auc"]
    if not pos or not neg:
        assert got is None
        return
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert abs(got - wins / (len(pos) * len(neg))) < 1e-12


def test_grid_search_runs_resume_and_pick(spark, workdir):
    lab = tables.labeled(spark, SF_SMALL)
    tr, te = split_train_test(lab)
    grid = {"lr": [(50, 0.0, 0.0), (100, 0.1, 0.0)], "dt": [(5, 32)]}
    runs_path, root = f"{workdir}/runs", f"{workdir}/models"
    runs = models.grid_search(spark, "intent", grid, tr, te, runs_path, root)
    assert runs.count() == 3
    assert models.pending_grid(spark, "intent", grid, runs_path).count() == 0
    again = models.grid_search(spark, "intent", grid, tr, te, runs_path, root)
    assert again.count() == 3                                  # resumed: nothing refitted
    best = models.best_model(again, "intent").first()
    assert best["auc"] == again.agg(F.max("auc")).first()[0]
    assert models.model_scores(again, "intent").count() == 2
    model = models.load_run_model(best)
    scored = score_intent(model, te)
    probs = scored.select("purchase_prob").collect()
    assert all(0.0 <= r["purchase_prob"] <= 1.0 for r in probs)
    up = purchase_uplift(model, te)
    assert up.count() == te.count()


def test_category_pipeline_serves_without_label(spark, workdir):
    cs = tables.features(spark, SF_SMALL, include_labels=True)
    idx = fit_category_labels(cs)
    data = idx.transform(cs)
    tr, te = split_train_test(data)
    runs = models.grid_search(spark, "category", {"dt": [(5,)]}, tr, te,
                              f"{workdir}/runs", f"{workdir}/models", list(idx.labels))
    model = models.load_run_model(runs.first())
    serving = cs.drop("label_category")
    out = score_category(model, serving).select("top3_category_indices", "top3_categories",
                                               "predicted_category").collect()
    labels = set(idx.labels)
    for r in out:
        assert len(set(r["top3_category_indices"])) == 3
        assert set(r["top3_categories"]) <= labels
        assert r["predicted_category"] in labels


def test_evaluator_close_to_exact_auc(spark, workdir):
    rng = random.Random(7)
    rows = [(float(rng.randint(0, 50)), rng.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    exact = exact_auc(df, "score").first()["auc"]
    assert abs(ev.evaluate(df.withColumn("label", F.col("label").cast("double"))) - exact) < 1e-9


def test_runs_lookup_by_params_and_metadata(spark, workdir):
    import json
    lab = tables.labeled(spark, SF_SMALL)
    tr, te = split_train_test(lab)
    grid = {"lr": [(100, 0.01, 0.5)], "nb": [(0.5, "multinomial")]}
    runs = models.grid_search(spark, "intent", grid, tr, te, f"{workdir}/runs", f"{workdir}/m")
    hit = models.runs_with_params(runs, "intent", "lr", (100, 0.01, 0.5)).collect()
    assert len(hit) == 1 and hit[0]["param_map"]["regParam"] == "0.01"     # typed, not int-cast
    assert models.runs_with_params(runs, "intent", "lr", (100.0, 0.01, 0.5)).count() == 1
    assert models.runs_with_params(runs, "intent", "lr", (100, 0.01, 0)).count() == 0
    meta = json.loads(hit[0]["model_params"])
    assert meta["maxIter"] == 100 and meta["elasticNetParam"] == 0.5
    nb = models.runs_with_params(runs, "intent", "nb", (0.5, "multinomial")).first()
    assert json.loads(nb["model_params"])["modelType"] == "multinomial"
    assert models.best_per_model(runs, "intent").count() == 2


def test_choose_model_by_params_or_best(spark):
    import pytest
    from basketlens.plans import training
    training.train(spark, SF_SMALL, "intent", {"lr": [(50, 0.0, 0.0)], "dt": [(5, 32)]})
    m, row = training.choose_model(spark, SF_SMALL, "intent", "dt", (5, 32))
    assert row["model"] == "dt" and row["params"] == "5_32"
    _, best = training.choose_model(spark, SF_SMALL, "intent")
    runs = models.read_runs(spark, training.runs_path(spark, SF_SMALL)).filter("task = 'intent'")
    assert best["auc"] == runs.agg(F.max("auc")).first()[0]
    with pytest.raises(LookupError):
        training.choose_model(spark, SF_SMALL, "intent", "rf", (1, 1, 1))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1, allow_nan=False), st.integers(0, 1)),
                min_size=2, max_size=60),
       st.sampled_from([2, 3, 8]))
def test_exact_auc_continuous_scores_bucketed(spark, rows, buckets):
    """Continuous scores cut into few buckets: still the exact rank-sum AUC."""
    rows = rows + [(rows[0][0], 1 - rows[0][1])]             # force a tie across labels
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    df = spark.createDataFrame(rows, "score double, label int")
    got = exact_auc(df, "score", buckets=buckets).first()["auc"]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert abs(got - wins / (len(pos) * len(neg))) < 1e-12
    grouped = exact_auc(df.withColumn("g", F.lit("a")), "score", by=["g"],
                        buckets=buckets).first()["auc"]
    assert abs(grouped - got) < 1e-12


def test_forest_rows_keep_their_node(spark):
    """Deep forests and trees don't send all nodes grown so far with every pass; the forest is the same."""
    tr, _ = split_train_test(tables.labeled(spark, SF_SMALL))
    vectors = models.feature_pipeline("intent").fit(tr).transform(tr).select("features", "label").persist()
    forest = models.make_estimator("intent", "rf", (5, 12, 32))
    assert forest.getCacheNodeIds() and models.make_estimator("category", "dt", (10,)).getCacheNodeIds()

    def text(estimator):
        return estimator.fit(vectors).toDebugString.split("\n", 1)[1]

    assert text(forest) == text(forest.copy({forest.cacheNodeIds: False}))


def test_fits_start_from_a_short_lineage(spark):
    """Tasks of a fit don't get the way back to the session table; rows and partitions stay."""
    from basketlens.plans import training
    lab = training.intent_sessions(spark, SF_SMALL)
    vectors = models.feature_pipeline("intent").fit(lab).transform(lab).select("features", "label")

    def dealt(frame):
        return sorted((r["p"], str(r["features"]), r["label"])
                      for r in frame.withColumn("p", F.spark_partition_id()).collect())

    frame = models.fit_frame(vectors)
    assert vectors.inputFiles() and not frame.inputFiles()
    before = vectors.persist()
    try:
        assert frame.rdd.getNumPartitions() == before.rdd.getNumPartitions()
        assert dealt(frame) == dealt(before)
    finally:
        before.unpersist(), frame.unpersist()


def test_boosted_points_of_other_length_are_one_fit(spark, workdir, monkeypatch):
    """The shorter point gets the longer fit's first trees: the model, scores and saved pipeline of a fit of its own."""
    import json
    tr, te = split_train_test(tables.labeled(spark, SF_SMALL))
    features = models.feature_pipeline("intent").fit(tr)
    vectors = models.fit_frame(features.transform(tr))
    own = models.make_estimator("intent", "gbt", (2, 4, 32)).fit(vectors)
    scores = models.evaluate("intent", own.transform(features.transform(te)))
    fits, fit = [], models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, frame: fits.append(self.getMaxIter()) or fit(self, frame))
    grid = {"gbt": [(2, 4, 32), (5, 4, 32), (3, 2, 32)], "dt": [(5, 32)]}
    runs = models.grid_search(spark, "intent", grid, tr, te, f"{workdir}/runs", f"{workdir}/models", features=features)
    assert sorted(fits) == [3, 5] and runs.count() == 4
    row = runs.filter("model = 'gbt' and params = '2_4_32'").first()
    saved = models.load_run_model(row).stages[-1]
    assert saved.toDebugString.split("\n", 1)[1] == own.toDebugString.split("\n", 1)[1]
    assert (saved.numFeatures, saved.treeWeights, saved.featureImportances) == (
        own.numFeatures, own.treeWeights, own.featureImportances)
    assert json.loads(row["model_params"]) == {p.name: v for p, v in own.extractParamMap().items()}
    assert row["auc"] == scores["auc"] and abs(row["pr_auc"] - scores["pr_auc"]) < 1e-12
    # a shorter point that comes later is a fit of its own, like any pending one
    later = {"gbt": [(1, 4, 32), (5, 4, 32)]}
    models.grid_search(spark, "intent", later, tr, te, f"{workdir}/runs", f"{workdir}/models", features=features)
    assert fits[2:] == [1]
    vectors.unpersist()


def test_both_areas_come_from_one_sorted_pass(spark):
    """Scoring, counting and sorting run once for the two areas, which are the evaluators' own."""
    rng = random.Random(11)
    rows = [(float(rng.randint(0, 40)), float(rng.randint(0, 1))) for _ in range(500)]
    scored = spark.createDataFrame(rows, "rawPrediction double, label double").repartition(4).persist()
    sc = spark.sparkContext

    def jobs(name, work):
        sc.setJobGroup(name, name)
        try:
            return work(), len(sc.statusTracker().getJobIdsForGroup(name))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)

    def area(name):
        return models.BinaryClassificationEvaluator(labelCol="label", metricName=name, numBins=0).evaluate(scored)

    try:
        scored.count()
        roc, one = jobs("area-roc", lambda: area("areaUnderROC"))
        pr, other = jobs("area-pr", lambda: area("areaUnderPR"))
        got, both = jobs("areas", lambda: models.evaluate("intent", scored))
    finally:
        scored.unpersist()
    assert abs(got["auc"] - roc) < 1e-12 and abs(got["pr_auc"] - pr) < 1e-12 and got["accuracy"] is None
    assert both < one + other


def test_merges_of_a_fit_take_a_task_per_core(spark, workdir):
    """The statistics of a pass are merged in as many tasks as there are cores, not as the frame has partitions; the trees stay."""
    tr, te = split_train_test(tables.labeled(spark, SF_SMALL))
    features = models.feature_pipeline("intent").fit(tr)
    tr, te = tr.repartition(12, "user_session"), te.repartition(3, "user_session")
    vectors = models.fit_frame(features.transform(tr))
    sc, grid = spark.sparkContext, {"gbt": [(3, 4, 32)]}

    def tasks(name, work):
        """What ``work`` returns, and the tasks of the stages that read rows and of those that merge."""
        sc.setJobGroup(name, name)
        try:
            out, tracker = work(), sc.statusTracker()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(name)
                  for s in (tracker.getJobInfo(j).stageIds if tracker.getJobInfo(j) else [])]
        # a pass: a stage that reads the rows and one that merges; the merge of the split candidates is not one
        return out, *({s.numTasks for s in stages if s and s.name == f"{kind} at RandomForest.scala:{line}"}
                      for kind, line in (("mapPartitions", 674), ("collectAsMap", 693)))

    try:
        own, rows, merges = tasks("own", lambda: models.make_estimator("intent", "gbt", grid["gbt"][0]).fit(vectors))
        assert (rows, merges) == ({12}, {12})
        runs, rows, merges = tasks("grid", lambda: models.grid_search(
            spark, "intent", grid, tr, te, f"{workdir}/runs", f"{workdir}/models", features=features))
    finally:
        vectors.unpersist()
    assert (rows, merges) == ({12}, {sc.defaultParallelism}) and sc.defaultParallelism < 12
    saved = models.load_run_model(runs.first()).stages[-1]
    assert saved.toDebugString.split("\n", 1)[1] == own.toDebugString.split("\n", 1)[1]
    assert sc._conf.get("spark.default.parallelism") is None


def test_merges_keep_a_deployers_setting(spark):
    from basketlens.session import merges_by_cores, merges_by_partitions
    conf = spark.sparkContext._jsc.sc().conf()
    key, cores = "spark.default.parallelism", str(spark.sparkContext.defaultParallelism)
    with merges_by_cores(spark):
        with merges_by_cores(spark):
            assert conf.get(key) == cores
        with merges_by_partitions(spark):
            assert not conf.contains(key)
            with merges_by_cores(spark):
                assert not conf.contains(key)
        assert conf.get(key) == cores                       # the outer one still runs
    assert not conf.contains(key)
    conf.set(key, "3")
    try:
        with merges_by_cores(spark), merges_by_partitions(spark):
            assert conf.get(key) == "3"
        assert conf.get(key) == "3"
    finally:
        conf.remove(key)
