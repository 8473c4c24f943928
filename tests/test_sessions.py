"""Cleaning, session roll-up, labels (FIXTURES F1 -> F2 / F3) and the
equivalence of the one-pass roll-up with the original three-aggregate form."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketlens.operators.clean import categorized_events, clean_events
from basketlens.operators.sessions import (labeled_sessions, purchase_labels, session_features,
                                           session_main_category)
from basketlens.plans import tables
from joined_form import joined_features
from conftest import SF_SMALL


def _by_session(df):
    return {r["user_session"]: r for r in df.collect()}


def test_clean_drops_bad_rows_keeps_null_time(f1_events):
    clean = clean_events(f1_events)
    sessions = {r["user_session"] for r in clean.collect()}
    assert sessions == {"a", "b", "c", "d", "e", "h"}
    assert clean.count() == 11
    h = clean.filter("user_session = 'h'").first()
    assert h["event_time"] is None


def test_categorized_first_path_element(f1_events):
    cat = categorized_events(clean_events(f1_events))
    assert cat.count() == 10
    firsts = {r["category_main"] for r in cat.collect()}
    assert firsts == {"toys", "garden"}


def test_session_features_f2(f1_events):
    got = _by_session(session_features(clean_events(f1_events)))
    expect = {
        "a": (2, 1, 0, 60, 40 / 3, "toys", 2),
        "b": (2, 0, 0, 5, 6.0, "garden", 2),
        "c": (1, 0, 0, 0, 7.0, "garden", 1),
        "d": (0, 0, 1, 0, None, "toys", 1),
        "e": (0, 0, 2, 1, 3.5, "garden", 2),
        "h": (1, 0, 0, None, 1.0, "toys", 1),
    }
    assert set(got) == set(expect)
    for s, (v, c, p, dur, avg, main, uniq) in expect.items():
        r = got[s]
        assert (r["num_views"], r["num_cart_adds"], r["num_purchases"]) == (v, c, p), s
        assert r["session_duration"] == dur, s
        assert (r["avg_price"] is None and avg is None) or r["avg_price"] == pytest.approx(avg), s
        assert r["main_category"] == main, s
        assert r["unique_categories"] == uniq, s


def test_label_category_earliest_purchase(f1_events):
    got = _by_session(session_features(clean_events(f1_events), include_labels=True))
    assert set(got) == {"d", "e"}            # c's purchase has no category
    assert got["e"]["label_category"] == "toys"
    assert got["d"]["label_category"] == "toys"


def test_labels_f3_from_clean_events(f1_events):
    clean = clean_events(f1_events)
    lab = _by_session(labeled_sessions(clean))
    assert {s: r["label"] for s, r in lab.items()} == {"a": 0, "b": 0, "c": 1, "d": 1, "e": 1, "h": 0}
    # c: label 1 although its only purchase had no category (num_purchases 0)
    assert lab["c"]["num_purchases"] == 0
    # numeric NULLs -> 0 at labelling
    assert lab["d"]["avg_price"] == 0.0 and lab["h"]["session_duration"] == 0
    assert _by_session(purchase_labels(clean))["c"]["label"] == 1


def test_main_category_window_form(f1_events):
    got = {r["user_session"]: r["main_category"]
           for r in session_main_category(clean_events(f1_events)).collect()}
    assert got["b"] == "garden" and got["e"] == "garden" and got["a"] == "toys"


@pytest.mark.parametrize("include_labels", [False, True])
def test_one_pass_equals_joined_form(spark, include_labels):
    clean = tables.clean(spark, SF_SMALL)
    a = tables.rounded_price(session_features(clean, include_labels))
    b = tables.rounded_price(joined_features(clean, include_labels).select(*a.columns))
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def test_survey_regression_counts(spark):
    clean = tables.clean(spark, SF_SMALL)
    assert clean.count() == 586
    assert clean.select("user_session").distinct().count() == 322
    assert categorized_events(clean).count() == 510
    lab = labeled_sessions(clean)
    assert lab.count() == 299
    assert lab.filter("label = 1").count() == 150
    assert lab.filter("num_purchases > 0").count() == 134


def test_session_counts_add_up(spark):
    clean = tables.clean(spark, SF_SMALL)
    feats = session_features(clean)
    tot = feats.agg(F.sum(F.col("num_views") + F.col("num_cart_adds") + F.col("num_purchases"))).first()[0]
    assert tot == categorized_events(clean).count()
    assert feats.filter("unique_categories < 1").count() == 0


def test_sinks_replace_all_and_read_back(spark, workdir):
    from basketlens.sources.events import read_scored_sessions, sample_rows, sample_sessions
    from basketlens.sources.sinks import save_scored_sessions, write_table
    lab = tables.labeled(spark, SF_SMALL)
    path = f"{workdir}/predicted_intents"
    save_scored_sessions(lab.withColumn("_id", F.lit(1)), path)
    save_scored_sessions(lab.limit(10), path)                   # replace-all
    back = read_scored_sessions(spark, path)
    assert back.count() == 10 and "_id" not in back.columns
    assert "purchase_prob" not in back.columns and "label" in back.columns
    src = spark.read.parquet(path)
    with pytest.raises(ValueError):
        write_table(src, path)                                  # never overwrite the input
    raw = tables.raw_events(spark, SF_SMALL)
    s = sample_sessions(raw, per_mille=500)
    inside = s.select("user_session").distinct()
    whole = raw.join(inside, "user_session", "left_semi")
    assert whole.count() == s.count()                           # sessions kept whole
    assert sample_rows(raw).count() < raw.count()


def test_pre_purchase_features_fixture(f1_events):
    lab = _by_session(labeled_sessions(clean_events(f1_events), pre_purchase_only=True))
    # d and e start with their purchase: nothing observed before it
    assert set(lab) == {"a", "b", "c", "h"}
    c = lab["c"]                       # the view before the (uncategorised) purchase
    assert (c["num_views"], c["num_purchases"], c["label"], c["avg_price"]) == (1, 0, 1, 7.0)
    assert lab["a"]["num_cart_adds"] == 1 and lab["a"]["label"] == 0


RAW_DDL = ("event_id bigint, event_time timestamp_ntz, event_type string, product_id int, "
           "category_code string, price double, user_id bigint, user_session string")
EVENT = st.tuples(st.sampled_from(["a", "b", "c"]),
                  st.sampled_from(["view", "cart", "purchase", "signup"]),
                  st.sampled_from(["toys.x", "toys.y", "garden.z", "tools", None]),
                  st.one_of(st.none(), st.integers(0, 20)),        # second of the minute; None: bad time
                  st.one_of(st.none(), st.sampled_from([1.0, 2.5, 4.0])))


@settings(max_examples=10, deadline=None)
@given(st.lists(EVENT, min_size=1, max_size=30))
def test_rollup_forms_agree_on_random_events(spark, rows):
    """Random events full of ties and NULLs: the one-pass roll-up equals the
    original three-aggregate form, and the salted pre-purchase join (thresholds
    forced low) equals the unsalted one."""
    from datetime import datetime
    from basketlens.operators import sessions as S
    data = [(i, None if sec is None else datetime(2024, 1, 1, 10, 0, sec), et, i % 5, cat, price,
             1, sess) for i, (sess, et, cat, sec, price) in enumerate(rows)]
    clean = clean_events(spark.createDataFrame(data, RAW_DDL))
    for include_labels in (False, True):
        a = tables.rounded_price(session_features(clean, include_labels))
        b = tables.rounded_price(joined_features(clean, include_labels).select(*a.columns))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plain = tables.rounded_price(labeled_sessions(clean, pre_purchase_only=True))
    saved = S.HOT_SESSION_ROWS
    S.HOT_SESSION_ROWS = 2                                 # > 2 events: hot
    try:
        salted = tables.rounded_price(labeled_sessions(clean, pre_purchase_only=True))
    finally:
        S.HOT_SESSION_ROWS = saved
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
