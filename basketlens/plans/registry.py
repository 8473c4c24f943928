"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver's tables (or data Spark derives from them) in
full.  Keys match ``basketlens.plans.oracle.ORACLE_SQL`` where an oracle
exists; column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pyspark.ml.functions import vector_to_array

from basketlens.functions.columns import in_train_split, lookup_labels, top_k_indices
from basketlens.operators import bayes, models
from basketlens.operators.evaluation import accuracy, feature_auc, feature_pr_area
from basketlens.operators.features import (fit_category_labels, fit_intent_features, indexer_labels, label_map,
                                           onehot_slots, split_train_test)
from basketlens.operators.scoring import (decode_predictions, feature_importances,
                                          purchase_uplift, score_category, score_intent, what_if)
from basketlens.operators import funnel as fn
from basketlens.operators.clean import categorized_events
from basketlens.operators.sessions import (labeled_sessions, purchase_labels,
                                           rollup_features, session_category_counts, session_main_category)
from basketlens.plans import data_runs, growth, session_tables, streams, tables, training
from basketlens.schemas import SESSION_FEATURE_COLUMNS
from basketlens.session import scratch_path
from basketlens.schemas import RAW_EVENT_CSV_SCHEMA, SESSION_MESSAGE_SCHEMA
from basketlens.sources.events import load_events_csv, sample_rows, sample_sessions
from basketlens.sources.messages import (decode_session_messages, encode_session_messages,
                                         with_message_defaults)
from basketlens.sources.events import read_scored_sessions
from basketlens.streaming.scoring import read_quarantine, read_scored
from basketlens.sources.sinks import save_scored_sessions, scored_columns, write_table

Query = Callable[[SparkSession, str], DataFrame]


def q_load_events(spark, sf_dir):
    return tables.raw_events(spark, sf_dir)


def q_clean_events(spark, sf_dir):
    return tables.clean(spark, sf_dir)


def q_categorized_events(spark, sf_dir):
    return categorized_events(tables.clean(spark, sf_dir))


def q_event_counts(spark, sf_dir):
    raw = tables.raw_events(spark, sf_dir)
    has_ids = F.col("user_id").isNotNull() & F.col("user_session").isNotNull()
    kept = has_ids & F.col("event_type").isin("view", "cart", "purchase")
    return raw.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.count_if(kept).alias("n_clean"),
        F.count_if(kept & F.col("category_code").isNotNull()).alias("n_categorized"))


def q_sample_sessions(spark, sf_dir):
    return sample_sessions(tables.raw_events(spark, sf_dir))


def q_load_events_csv(spark, sf_dir):
    """A1 over the real tables: events written as all-text header CSV (the
    original's input format), read back through the declared-schema reader."""
    path = scratch_path(spark, "events_csv")
    raw = tables.raw_events(spark, sf_dir)
    text = raw.select(*[(F.col(c).cast("string") if c in raw.columns else F.lit(None).cast("string"))
                        .alias(c) for c in RAW_EVENT_CSV_SCHEMA.fieldNames()])
    text.write.option("header", True).csv(path)
    return load_events_csv(spark, path).drop("event_id", "corrupt_record")


def q_sample_rows(spark, sf_dir):
    """A2 as the original: seeded 2.5 % Bernoulli row sample (Spark's sampler,
    so no SQL oracle; the session-preserving form has one)."""
    return sample_rows(tables.raw_events(spark, sf_dir))


def q_session_category_counts(spark, sf_dir):
    lvl = session_category_counts(tables.clean(spark, sf_dir))
    return (lvl.filter(F.col("category_main").isNotNull())
               .select("user_session", "category_main", F.col("n_events").alias("count")))


def q_session_main_category(spark, sf_dir):
    return session_main_category(tables.clean(spark, sf_dir))


def q_purchase_labels(spark, sf_dir):
    return purchase_labels(tables.clean(spark, sf_dir))


def q_session_features(spark, sf_dir):
    return tables.rounded_price(tables.features(spark, sf_dir))


def q_write_read_features(spark, sf_dir):
    path = scratch_path(spark, "session_features")
    write_table(tables.features(spark, sf_dir), path, source_paths=[sf_dir])
    return tables.rounded_price(spark.read.parquet(path))


def q_labeled_sessions(spark, sf_dir):
    return tables.rounded_price(tables.labeled(spark, sf_dir))


def q_pre_purchase_sessions(spark, sf_dir):
    """Q4 option: labeled sessions with features from pre-purchase events only."""
    return tables.rounded_price(labeled_sessions(tables.clean(spark, sf_dir), pre_purchase_only=True))


def q_pre_purchase_bucketed(spark, sf_dir):
    """The same rows from stored, bucketed tables: a join without an exchange."""
    return tables.rounded_price(session_tables.pre_purchase_sessions(spark, sf_dir))


def q_labeled_join(spark, sf_dir):
    """E4 as the original joins it, over two bucketed tables."""
    return tables.rounded_price(session_tables.labeled_join(spark, sf_dir))


def q_incremental_features(spark, sf_dir):
    """C1-C7, D1 from partials of three folds of the events, the later files alone
    read by the later folds."""
    return tables.rounded_price(rollup_features(growth.grown_rollup(spark, sf_dir).rollup()))


def q_incremental_folds(spark, sf_dir):
    """What each fold read: rows of the files that were new, rows kept of them."""
    return growth.grown_rollup(spark, sf_dir).folded().groupBy("fold").agg(
        F.sum("n_raw").alias("n_raw"), F.sum("n_clean").alias("n_clean"))


def q_drop_reasons(spark, sf_dir):
    """Rows dropped and kept by reason, counted by the pass that cleans."""
    return growth.clean_and_count(spark, tables.raw_events(spark, sf_dir))


def q_csv_drop_reasons(spark, sf_dir):
    """A1 with B2-B4: the same over CSV that holds lines which are no records."""
    return growth.clean_and_count(spark, load_events_csv(spark, growth.csv_with_foreign_lines(spark, sf_dir)))


def q_category_sessions(spark, sf_dir):
    return tables.rounded_price(tables.features(spark, sf_dir, include_labels=True))


def q_funnel(spark, sf_dir):
    return fn.funnel(tables.labeled(spark, sf_dir))


def q_test_split_funnel(spark, sf_dir):
    """C8 + C10 exactly as the original reports: over the scored 20 % test
    split (scoring keeps num_cart_adds, label, main_category as they are)."""
    _, test = split_train_test(tables.labeled(spark, sf_dir))
    return fn.funnel_by_category_with_total(test)


def q_funnel_dropoff(spark, sf_dir):
    return fn.funnel_dropoff(tables.labeled(spark, sf_dir))


def q_category_funnel(spark, sf_dir):
    return fn.category_funnel(tables.labeled(spark, sf_dir))


def q_category_conversion(spark, sf_dir):
    return fn.category_conversion(tables.labeled(spark, sf_dir))


def q_price_histogram(spark, sf_dir):
    """Reports read the stored session table (written once per dataset)."""
    return fn.price_histogram(tables.rounded_price(training.intent_sessions(spark, sf_dir)))


def q_duration_price_grid(spark, sf_dir):
    return fn.duration_price_grid(tables.rounded_price(training.intent_sessions(spark, sf_dir)))


def q_split_counts(spark, sf_dir):
    lab = tables.labeled(spark, sf_dir)
    split = F.when(in_train_split("user_session"), "train").otherwise("test")
    return lab.groupBy(split.alias("split"), "label").agg(F.count(F.lit(1)).alias("n"))


def q_session_messages(spark, sf_dir):
    """A11 + K1: encode category sessions as JSON messages, decode them back."""
    msgs = encode_session_messages(tables.features(spark, sf_dir, include_labels=True))
    dec = decode_session_messages(msgs)
    cols = [c for c in SESSION_FEATURE_COLUMNS if c != "user_session"] + ["label_category"]
    return tables.rounded_price(dec.select(F.col("user_session").alias("key"), *cols))


def q_defaulted_sessions(spark, sf_dir):
    msgs = encode_session_messages(tables.features(spark, sf_dir, include_labels=True))
    return tables.rounded_price(with_message_defaults(decode_session_messages(msgs)))


def q_main_category_accuracy(spark, sf_dir):
    """J9 on a data-derived predictor: does a session buy its main category?"""
    cs = tables.features(spark, sf_dir, include_labels=True)
    hit = F.col("main_category") == F.col("label_category")
    return cs.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("correct"),
                  F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("accuracy"))



# ---------------------------------------------------------------------------
# Feature pipeline, label maps, training, scoring (MLlib)
# ---------------------------------------------------------------------------
def _intent_features(spark, sf_dir):
    """Fit on the stored session table, as training does (fit + transform are
    two passes; over a written table the second is a pruned scan)."""
    lab = training.intent_sessions(spark, sf_dir)
    return lab, fit_intent_features(lab)


def q_label_map(spark, sf_dir):
    _, fitted = _intent_features(spark, sf_dir)
    return label_map(spark, fitted)


def q_category_label_map(spark, sf_dir):
    cs = training.category_sessions(spark, sf_dir)
    return label_map(spark, fit_category_labels(cs))


def q_indexed_sessions(spark, sf_dir):
    lab, fitted = _intent_features(spark, sf_dir)
    return fitted.transform(lab).select("user_session", "main_category", "main_category_index")


def q_category_sessions_indexed(spark, sf_dir):
    cs = training.category_sessions(spark, sf_dir)
    return fit_category_labels(cs).transform(cs).select("user_session", "label_category", "label")


def q_onehot(spark, sf_dir):
    lab, fitted = _intent_features(spark, sf_dir)
    return onehot_slots(fitted.transform(lab))


def q_assembled(spark, sf_dir):
    lab, fitted = _intent_features(spark, sf_dir)
    return fitted.transform(lab).select("user_session", vector_to_array("features").alias("features"))


def q_feature_auc(spark, sf_dir):
    return feature_auc(tables.labeled(spark, sf_dir),
                       ["num_views", "num_cart_adds", "unique_categories"])


PR_FEATURES = ["num_views", "num_cart_adds", "unique_categories", "session_duration", "avg_price"]


def q_feature_pr_area(spark, sf_dir):
    """J8 on its own: every feature as a score, continuous ones included."""
    return feature_pr_area(tables.rounded_price(tables.labeled(spark, sf_dir)), PR_FEATURES)


def _smoothings():
    return [p[0] for p in models.INTENT_GRIDS["nb"]]


def q_nb_parameters(spark, sf_dir):
    """The parameters of the naive Bayes grid from one grouped aggregate."""
    sessions = tables.rounded_price(training.intent_sessions(spark, sf_dir))
    train, _ = split_train_test(sessions)
    out = bayes.parameters(bayes.slot_sums(sessions, train), _smoothings())
    return out.withColumn("log_prob", F.round("log_prob", 9))


def q_nb_relational(spark, sf_dir):
    """The naive Bayes grid fitted, scored and evaluated by aggregates."""
    sessions = tables.rounded_price(training.intent_sessions(spark, sf_dir))
    runs = bayes.naive_bayes_runs(sessions, *split_train_test(sessions), _smoothings())
    return _nb_rows(runs.withColumn("params", F.concat("smoothing", F.lit("_multinomial"))))


def q_nb_fitted(spark, sf_dir):
    """The same grid as MLlib fitted it."""
    runs = training.train(spark, sf_dir, "intent", {"nb": models.INTENT_GRIDS["nb"]})
    return _nb_rows(runs.filter(F.col("model") == "nb"))


def _nb_scored(spark, sf_dir):
    """Test sessions scored by the fitted naive Bayes run, whose probability has an
    SQL form; six places are exact."""
    runs = training.train(spark, sf_dir, "intent", {"nb": models.INTENT_GRIDS["nb"]})
    model = models.load_run_model(runs.filter("model = 'nb' and params = '1.0_multinomial'").first())
    _, test = split_train_test(tables.rounded_price(training.intent_sessions(spark, sf_dir)))
    return model, test, score_intent(model, test).withColumn("purchase_prob", F.round("purchase_prob", 6))


def q_nb_probability(spark, sf_dir):
    """Prediction and class-1 probability of a fitted model, exact."""
    return _nb_scored(spark, sf_dir)[2].select("user_session", "label", "prediction", "purchase_prob")


def q_nb_scored_store(spark, sf_dir):
    """Scored sessions saved and read back, every column exact."""
    path = scratch_path(spark, "nb_intents")
    save_scored_sessions(_nb_scored(spark, sf_dir)[2], path)
    return read_scored_sessions(spark, path)


def q_nb_prediction_histogram(spark, sf_dir):
    """C12 over an exact probability."""
    return fn.prediction_histogram(spark.read.parquet(
        save_scored_sessions(_nb_scored(spark, sf_dir)[2], scratch_path(spark, "nb_intents"))))


def q_nb_uplift(spark, sf_dir):
    """Probability now and with one more cart add."""
    model, test, _ = _nb_scored(spark, sf_dir)
    return purchase_uplift(model, test, extra_cart_adds=1).select(
        "user_session", F.round("prob_now", 6).alias("prob_now"), F.round("prob_more_cart", 6).alias("prob_more_cart"))


def q_share_top3(spark, sf_dir):
    """the three likeliest categories by a probability made from the data, the
    share of a session's events per category in label order; order and names exact."""
    cs = training.category_sessions(spark, sf_dir).select("user_session")
    names = indexer_labels(fit_category_labels(training.category_sessions(spark, sf_dir)))
    counts = session_category_counts(tables.clean(spark, sf_dir)).filter(F.col("category_main").isNotNull())
    per = counts.join(cs, "user_session").groupBy("user_session").agg(
        F.map_from_entries(F.collect_list(F.struct("category_main", "n_events"))).alias("m"),
        F.sum("n_events").alias("total"))
    labels = F.array(*map(F.lit, names))
    prob = F.transform(labels, lambda c: F.coalesce(F.col("m")[c], F.lit(0)) / F.col("total"))
    top = per.select("user_session", top_k_indices(prob, 3).alias("idx"))
    return top.select("user_session", F.array_join(F.transform("idx", lambda i: i.cast("string")), ",").alias("indices"),
                      F.array_join(lookup_labels("idx", labels), ",").alias("categories"))


def _nb_rows(runs):
    return runs.select("params", F.round("auc", 9).alias("auc"), F.round("pr_auc", 9).alias("pr_auc"))


RUN_COLUMNS = ["task", "model", "params", "auc", "pr_auc", "accuracy"]


def _train_one(model: str):
    def q(spark, sf_dir):
        runs = training.train(spark, sf_dir, "intent", {model: models.INTENT_GRIDS[model]})
        return runs.filter(F.col("model") == model).select(*RUN_COLUMNS)
    q.__name__ = f"q_train_{model}"
    return q


def _runs(spark, sf_dir):
    training.train(spark, sf_dir, "intent")
    training.train(spark, sf_dir, "category")
    return models.read_runs(spark, training.runs_path(spark, sf_dir))


def q_train_category(spark, sf_dir):
    return training.train(spark, sf_dir, "category").select(*RUN_COLUMNS)


def q_append_results(spark, sf_dir):
    return _runs(spark, sf_dir).select("run_id", *RUN_COLUMNS, "model_path")


def q_pending_grid(spark, sf_dir):
    _runs(spark, sf_dir)
    rp = training.runs_path(spark, sf_dir)
    return (models.pending_grid(spark, "intent", models.INTENT_GRIDS, rp)
            .unionByName(models.pending_grid(spark, "category", models.CATEGORY_GRIDS, rp)))


def q_best_grid_row(spark, sf_dir):
    return models.best_grid_row(_runs(spark, sf_dir)).select(*RUN_COLUMNS)


def q_best_model(spark, sf_dir):
    return models.best_model(_runs(spark, sf_dir), "intent").select(*RUN_COLUMNS)


def q_best_run(spark, sf_dir):
    return models.best_model(_runs(spark, sf_dir), "category").select(*RUN_COLUMNS)


def q_model_scores(spark, sf_dir):
    return models.model_scores(_runs(spark, sf_dir), "intent")


def q_best_per_model(spark, sf_dir):
    return models.best_per_model(_runs(spark, sf_dir), "category")


def _intent_test(spark, sf_dir):
    model, _ = training.best_pipeline(spark, sf_dir, "intent")
    _, test = split_train_test(training.intent_sessions(spark, sf_dir))
    return model, test


def _category_test(spark, sf_dir):
    model, _ = training.best_pipeline(spark, sf_dir, "category")
    cs = training.category_sessions(spark, sf_dir)
    _, test = split_train_test(fit_category_labels(cs).transform(cs))
    return model, test


def q_scored_sessions(spark, sf_dir):
    model, test = _intent_test(spark, sf_dir)
    scored = score_intent(model, test)
    return scored.select(*scored_columns(scored))


def q_scored_store(spark, sf_dir):
    """A8 + A9: scored sessions saved replace-all to the predicted_intents
    table, then read back without the store's own id."""
    model, test = _intent_test(spark, sf_dir)
    path = f"{training.workspace(spark, sf_dir)}/predicted_intents"
    save_scored_sessions(score_intent(model, test), path)
    return read_scored_sessions(spark, path)


def q_run_by_params(spark, sf_dir):
    """The runs of a model whose typed params equal a given grid point."""
    runs = _runs(spark, sf_dir)
    model, point = "lr", models.INTENT_GRIDS["lr"][1]
    return models.runs_with_params(runs, "intent", model, point).select(*RUN_COLUMNS, "param_map", "model_params",
                                                                        "model_path")


def q_purchase_probability(spark, sf_dir):
    model, test = _intent_test(spark, sf_dir)
    return score_intent(model, test).select("user_session", "label", "prediction", "purchase_prob")


def q_prediction_histogram(spark, sf_dir):
    model, test = _intent_test(spark, sf_dir)
    return fn.prediction_histogram(score_intent(model, test))


def q_auc(spark, sf_dir):
    model, test = _intent_test(spark, sf_dir)
    m = models.evaluate("intent", model.transform(test))
    return spark.createDataFrame([(m["auc"], m["pr_auc"])], "auc double, pr_auc double")


def q_auc_pr(spark, sf_dir):
    """Area under the precision-recall curve of the best intent model."""
    model, test = _intent_test(spark, sf_dir)
    pr = models.BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR", numBins=0)
    return spark.createDataFrame([(pr.evaluate(model.transform(test)),)], "pr_auc double")


def q_accuracy(spark, sf_dir):
    model, test = _category_test(spark, sf_dir)
    return accuracy(model.transform(test))  # test carries the class index ``label``


def q_top3_categories(spark, sf_dir):
    model, test = _category_test(spark, sf_dir)
    return score_category(model, test).select(
        "user_session", "label_category", "predicted_category",
        "top3_category_indices", "top3_categories")


def q_decoded_predictions(spark, sf_dir):
    model, test = _category_test(spark, sf_dir)
    return decode_predictions(model.transform(test), label_map(spark, model)).select(
        "user_session", "label_category", "prediction", "predicted_category")


def q_feature_importances(spark, sf_dir):
    runs = training.train(spark, sf_dir, "intent", {"rf": models.INTENT_GRIDS["rf"]})
    row = models.best_grid_row(runs.filter(F.col("model") == "rf")).first()
    return feature_importances(spark, models.load_run_model(row), "intent")


def q_what_if(spark, sf_dir):
    model, test = _intent_test(spark, sf_dir)
    return purchase_uplift(model, test, extra_cart_adds=1)


SCENARIOS = {"as_is": {}, "more_cart": {"num_cart_adds": 3.0}, "cheap_and_short": {
    "avg_price": 5.0, "session_duration": 30.0}, "other_category": {"main_category": "unknown", "num_views": 10.0}}


def q_what_if_scenarios(spark, sf_dir):
    """I9 over counts, price, duration and category, scored by both models."""
    category, _ = training.best_pipeline(spark, sf_dir, "category")
    model, test = _intent_test(spark, sf_dir)
    out = what_if(model, category, tables.rounded_price(test), SCENARIOS)
    return out.select("user_session", "scenario", "num_views", "num_cart_adds", "avg_price", "session_duration",
                      "main_category", _in_unit("purchase_prob").alias("prob_ok"),
                      F.size(F.array_distinct("top3_categories")).alias("n_distinct"))


def q_run_metadata(spark, sf_dir):
    """Each run's classifier parameters, one row per parameter of the grid."""
    runs = _runs(spark, sf_dir)
    return runs.select("task", "model", "params", F.explode("param_map").alias("name", "value"),
                       F.length("model_params").alias("metadata_chars"))


# ---------------------------------------------------------------------------
# Runs computed from the data: the queries over the runs table, with an oracle
# ---------------------------------------------------------------------------
def q_data_runs(spark, sf_dir):
    return data_runs.runs(spark, sf_dir).select("run_id", *RUN_COLUMNS)


def q_data_best_grid_row(spark, sf_dir):
    return models.best_grid_row(data_runs.runs(spark, sf_dir)).select(*RUN_COLUMNS)


def q_data_best_model(spark, sf_dir):
    return models.best_model(data_runs.runs(spark, sf_dir), "intent").select(*RUN_COLUMNS)


def q_data_best_run(spark, sf_dir):
    return models.best_model(data_runs.runs(spark, sf_dir), "category").select(*RUN_COLUMNS)


def q_data_model_scores(spark, sf_dir):
    return models.model_scores(data_runs.runs(spark, sf_dir), "intent")


def q_data_best_per_model(spark, sf_dir):
    return models.best_per_model(data_runs.runs(spark, sf_dir), "category")


def q_data_pending_grid(spark, sf_dir):
    return data_runs.pending(spark, sf_dir).select("task", "model", "params")


def q_data_run_by_params(spark, sf_dir):
    """E8 over all sessions: the runs of one feature on one category."""
    runs = data_runs.runs(spark, sf_dir)
    first = runs.filter("task = 'intent'").agg(F.min("params")).first()[0]
    return models.runs_with_params(runs, "intent", "num_views", (first,)).select(*RUN_COLUMNS)


def _in_unit(column: str):
    return F.col(column).between(0.0, 1.0)


def q_scored_rows_checked(spark, sf_dir):
    """Scored test sessions: keys, inputs and label as given, probability in range."""
    model, test = _intent_test(spark, sf_dir)
    return score_intent(model, test).select(
        "user_session", "num_views", "num_cart_adds", "unique_categories", "main_category", "label",
        _in_unit("purchase_prob").alias("prob_ok"))


def q_top3_checked(spark, sf_dir):
    """Top three categories of the test sessions: three different ones, known ones."""
    model, test = _category_test(spark, sf_dir)
    top = F.col("top3_categories")
    return score_category(model, test).select(
        "user_session", "label_category", F.size(F.array_distinct(top)).alias("n_distinct"),
        (~F.array_contains(top, "unknown")).alias("known"))


def q_index_label_roundtrip(spark, sf_dir):
    """Class index -> name by the label map, on the true index of each session."""
    cs = training.category_sessions(spark, sf_dir)
    fitted = fit_category_labels(cs)
    rows = fitted.transform(cs).withColumn("prediction", F.col("label"))
    return decode_predictions(rows, label_map(spark, fitted)).select(
        "user_session", F.col("label").alias("index"), "predicted_category")


def q_index_accuracy(spark, sf_dir):
    """J9 through ``accuracy``: class 0 (the commonest) predicted for every session."""
    cs = training.category_sessions(spark, sf_dir)
    return accuracy(fit_category_labels(cs).transform(cs).withColumn("prediction", F.lit(0.0)))


def q_assembled_slots(spark, sf_dir):
    """The assembled vector, a row per slot that isn't 0."""
    lab = tables.rounded_price(training.intent_sessions(spark, sf_dir))
    vectors = fit_intent_features(lab).transform(lab).select(
        "user_session", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return vectors.filter("value <> 0")


# ---------------------------------------------------------------------------
# Streaming (file source + availableNow; Kafka is the same transform)
# ---------------------------------------------------------------------------
def q_stream_source(spark, sf_dir):
    return tables.rounded_price(streams.stream_source(spark, sf_dir))


def q_stream_scores(spark, sf_dir):
    paths = streams.run_scoring(spark, sf_dir)
    return read_scored(spark, paths["scored"]).drop("batch_id")


def q_stream_sink(spark, sf_dir):
    return streams.stream_sink(spark, sf_dir)


def q_stream_threshold(spark, sf_dir):
    paths = streams.run_scoring(spark, sf_dir, replays=2, threshold=2)
    return read_scored(spark, paths["scored"]).drop("batch_id")


def q_stream_threshold_checked(spark, sf_dir):
    """K2: every session of two replays comes once, with its first message's fields."""
    scored = q_stream_threshold(spark, sf_dir)
    fields = [F.col(f"features.{c}").alias(c) for c in ("num_views", "num_cart_adds", "num_purchases", "main_category")]
    return scored.select("user_session", *fields, _in_unit("purchase_prob").alias("prob_ok"),
                         F.size(F.array_distinct("top3_categories")).alias("n_distinct"))


def q_stream_quarantine(spark, sf_dir):
    paths = streams.run_scoring(spark, sf_dir, foreign=True)
    return read_quarantine(spark, paths["quarantine"]).select("value")


def q_stream_compacted(spark, sf_dir):
    """Every message once, after 20 micro-batches, merges and a restart."""
    fields = [f for f in SESSION_MESSAGE_SCHEMA.fields]
    return tables.rounded_price(streams.compacted_messages(spark, sf_dir).read(StructType(fields)))


def q_stream_hand_over(spark, sf_dir):
    return streams.handed_over(spark, sf_dir)


def q_stream_session_features(spark, sf_dir):
    return tables.rounded_price(streams.stream_session_features(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "load_events": q_load_events,
    "load_events_csv": q_load_events_csv,
    "clean_events": q_clean_events,
    "categorized_events": q_categorized_events,
    "event_counts": q_event_counts,
    "sample_sessions": q_sample_sessions,
    "sample_rows": q_sample_rows,
    "session_category_counts": q_session_category_counts,
    "session_main_category": q_session_main_category,
    "purchase_labels": q_purchase_labels,
    "session_features": q_session_features,
    "write_read_features": q_write_read_features,
    "labeled_sessions": q_labeled_sessions,
    "pre_purchase_sessions": q_pre_purchase_sessions,
    "pre_purchase_bucketed": q_pre_purchase_bucketed,
    "labeled_join": q_labeled_join,
    "incremental_features": q_incremental_features,
    "incremental_folds": q_incremental_folds,
    "drop_reasons": q_drop_reasons,
    "csv_drop_reasons": q_csv_drop_reasons,
    "category_sessions": q_category_sessions,
    "funnel": q_funnel,
    "funnel_dropoff": q_funnel_dropoff,
    "test_split_funnel": q_test_split_funnel,
    "category_funnel": q_category_funnel,
    "category_conversion": q_category_conversion,
    "price_histogram": q_price_histogram,
    "duration_price_grid": q_duration_price_grid,
    "split_counts": q_split_counts,
    "session_messages": q_session_messages,
    "defaulted_sessions": q_defaulted_sessions,
    "main_category_accuracy": q_main_category_accuracy,
    "label_map": q_label_map,
    "category_label_map": q_category_label_map,
    "indexed_sessions": q_indexed_sessions,
    "category_sessions_indexed": q_category_sessions_indexed,
    "onehot": q_onehot,
    "assembled": q_assembled,
    "feature_auc": q_feature_auc,
    "feature_pr_area": q_feature_pr_area,
    "nb_parameters": q_nb_parameters,
    "nb_relational": q_nb_relational,
    "nb_fitted": q_nb_fitted,
    "nb_probability": q_nb_probability,
    "nb_scored_store": q_nb_scored_store,
    "nb_prediction_histogram": q_nb_prediction_histogram,
    "nb_uplift": q_nb_uplift,
    "share_top3": q_share_top3,
    "train_rf": _train_one("rf"),
    "train_lr": _train_one("lr"),
    "train_dt": _train_one("dt"),
    "train_nb": _train_one("nb"),
    "train_gbt": _train_one("gbt"),
    "train_category": q_train_category,
    "append_results": q_append_results,
    "pending_grid": q_pending_grid,
    "best_grid_row": q_best_grid_row,
    "best_model": q_best_model,
    "best_run": q_best_run,
    "model_scores": q_model_scores,
    "best_per_model": q_best_per_model,
    "scored_sessions": q_scored_sessions,
    "scored_store": q_scored_store,
    "run_by_params": q_run_by_params,
    "purchase_probability": q_purchase_probability,
    "prediction_histogram": q_prediction_histogram,
    "auc": q_auc,
    "auc_pr": q_auc_pr,
    "accuracy": q_accuracy,
    "top3_categories": q_top3_categories,
    "decoded_predictions": q_decoded_predictions,
    "feature_importances": q_feature_importances,
    "what_if": q_what_if,
    "what_if_scenarios": q_what_if_scenarios,
    "run_metadata": q_run_metadata,
    "data_runs": q_data_runs,
    "data_best_grid_row": q_data_best_grid_row,
    "data_best_model": q_data_best_model,
    "data_best_run": q_data_best_run,
    "data_model_scores": q_data_model_scores,
    "data_best_per_model": q_data_best_per_model,
    "data_pending_grid": q_data_pending_grid,
    "data_run_by_params": q_data_run_by_params,
    "scored_rows_checked": q_scored_rows_checked,
    "top3_checked": q_top3_checked,
    "index_label_roundtrip": q_index_label_roundtrip,
    "index_accuracy": q_index_accuracy,
    "assembled_slots": q_assembled_slots,
    "stream_threshold_checked": q_stream_threshold_checked,
    "stream_source": q_stream_source,
    "stream_scores": q_stream_scores,
    "stream_sink": q_stream_sink,
    "stream_threshold": q_stream_threshold,
    "stream_quarantine": q_stream_quarantine,
    "stream_compacted": q_stream_compacted,
    "stream_hand_over": q_stream_hand_over,
    "stream_session_features": q_stream_session_features,
}
