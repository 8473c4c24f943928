"""Incremental roll-up, bucketed tables, commit points, counted cleaning."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from basketlens.operators import incremental
from basketlens.operators.clean import clean_events, drop_reasons, observed_clean
from basketlens.operators.incremental import IncrementalRollup, merged_partials, rollup_of_partials
from basketlens.operators.sessions import session_category_counts, session_rollup
from basketlens.plans import growth, session_tables, tables, training
from basketlens.sources.bucketed import BucketedTable
from basketlens.sources.commits import CommitLog, create_exclusive, file_system, list_files

RAW = ("event_id long, event_time timestamp_ntz, event_type string, product_id int, category_code string, "
       "price double, user_id long, user_session string")


def random_events(spark, n, seed):
    from datetime import datetime, timedelta
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = None if rng.random() < 0.05 else datetime(2024, 1, 1) + timedelta(seconds=rng.randint(0, 50))
        rows.append((i, at, rng.choice(["view", "cart", "purchase", "signup"]), rng.randint(1, 4),
                     rng.choice([None, "a.b", "a", "c.d", "b"]), None if rng.random() < 0.1 else float(rng.randint(1, 9)),
                     rng.choice([None, 1, 2]), rng.choice([None, "s1", "s2", "s3", "s4"])))
    return spark.createDataFrame(rows, RAW)


def as_set(df):
    cols = sorted(df.columns)
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                   for r in df.select(*cols).collect())


@pytest.mark.parametrize("seed", range(6))
def test_partials_roll_up_like_the_events(spark, seed):
    raw = random_events(spark, 120, seed)
    clean = clean_events(raw)
    parts = [session_category_counts(clean.filter(F.col("event_id") % 3 == i)) for i in range(3)]
    cells = parts[0].unionByName(parts[1]).unionByName(parts[2])
    whole = session_rollup(clean)
    assert as_set(rollup_of_partials(cells).select(*whole.columns)) == as_set(whole)
    assert as_set(rollup_of_partials(merged_partials(cells)).select(*whole.columns)) == as_set(whole)


@pytest.fixture()
def folded(spark, workdir, monkeypatch):
    monkeypatch.setattr(incremental, "MAX_VERSIONS", 3)
    raw = random_events(spark, 300, 11)
    read = []

    def reader(files):
        read.append(len(files))
        return spark.read.schema(RAW).parquet(*files)

    return raw, read, f"{workdir}/events", IncrementalRollup(spark, f"{workdir}/rollup", reader)


def append(raw, i, n, path):
    raw.filter(F.col("event_id") % n == i).coalesce(1).write.mode("append").parquet(path)


def test_only_new_files_are_read_and_versions_are_merged(spark, folded):
    raw, read, path, rollup = folded
    for i in range(6):
        append(raw, i, 6, path)
        assert rollup.fold(path) == 1
        assert len(list_files(spark, path)) == i + 1
    assert read == [1] * 6                                   # one file per fold, never the others again
    assert rollup.fold(path) == 0 and read == [1] * 6        # nothing new: nothing read
    whole = session_rollup(clean_events(raw))
    assert as_set(rollup.rollup().select(*whole.columns)) == as_set(whole)
    assert rollup.folded().select("version").distinct().count() <= 3
    assert rollup.folded().agg(F.sum("n_raw")).first()[0] == 300
    # what merged versions replaced can go, and the state stays
    assert rollup.vacuum() > 0
    assert as_set(rollup.rollup().select(*whole.columns)) == as_set(whole)


def test_another_application_goes_on_where_the_first_stopped(spark, folded):
    raw, read, path, rollup = folded
    append(raw, 0, 2, path)
    rollup.fold(path)
    again = IncrementalRollup(spark, rollup.log.path.rsplit("/", 1)[0], rollup.read_events)
    append(raw, 1, 2, path)
    assert again.fold(path) == 1
    whole = session_rollup(clean_events(raw))
    assert as_set(rollup.rollup().select(*whole.columns)) == as_set(whole)


def test_a_fold_that_died_leaves_nothing(spark, folded, monkeypatch):
    raw, read, path, rollup = folded
    append(raw, 0, 2, path)
    rollup.fold(path)
    append(raw, 1, 2, path)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(rollup.log, "commit", dies)
        with pytest.raises(OSError):
            rollup.fold(path)
    half = session_rollup(clean_events(raw.filter("event_id % 2 = 0")))
    assert as_set(rollup.rollup().select(*half.columns)) == as_set(half)
    assert rollup.fold(path) == 1
    whole = session_rollup(clean_events(raw))
    assert as_set(rollup.rollup().select(*whole.columns)) == as_set(whole)


def test_removed_and_rewritten_files_are_folded_anew(spark, folded):
    raw, read, path, rollup = folded
    for i in range(2):
        append(raw, i, 3, path)
    rollup.fold(path)
    fs, gone = file_system(spark, list_files(spark, path)[0].path)
    fs.delete(gone, False)
    append(raw, 2, 3, path)
    assert rollup.fold(path) == 2
    left = session_rollup(clean_events(spark.read.schema(RAW).parquet(path)))
    assert as_set(rollup.rollup().select(*left.columns)) == as_set(left)


def test_empty_source(spark, folded):
    raw, read, path, rollup = folded
    assert rollup.fold(path) == 0 and rollup.rollup().count() == 0
    raw.limit(0).write.parquet(path)
    rollup.fold(path)
    assert rollup.rollup().count() == 0


def test_commits_are_exclusive(spark, workdir):
    assert create_exclusive(spark, f"{workdir}/x/claim", "me")
    assert not create_exclusive(spark, f"{workdir}/x/claim", "you")
    assert spark.read.text(f"{workdir}/x/claim").first()[0] == "me"
    one, two = (CommitLog(spark, f"{workdir}/log", "a int") for _ in range(2))
    one.commit(1, spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(RuntimeError, match="another writer"):
        two.commit(1, spark.createDataFrame([(2,)], "a int"))
    assert two.latest()[0] == 1 and two.latest()[1].first().a == 1


def exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_joins_of_bucketed_tables_have_no_exchange(spark):
    events, firsts = session_tables.session_events(spark, SF_SMALL), session_tables.first_purchases(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(events.join(firsts, ["user_session", "_salt"], "left")) == 0
        assert exchanges(session_tables.labeled_join(spark, SF_SMALL)) == 0
        assert exchanges(session_tables.pre_purchase_sessions(spark, SF_SMALL)) == 1      # the roll-up's partial rows
        assert exchanges(training.intent_sessions(spark, SF_SMALL).groupBy("user_session").count()) == 0
        # the unbucketed form deals both sides
        assert exchanges(tables.labeled(spark, SF_SMALL).join(
            spark.createDataFrame([], "user_session string, x int"), "user_session")) >= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_session_is_spread_over_buckets(spark, workdir):
    from basketlens.operators.sessions import flagged_pre, purchase_stats, salted_sides
    raw = random_events(spark, 400, 5).withColumn("user_session", F.when(F.col("event_id") > 40, "hot").otherwise(
        F.col("user_session")))
    clean = clean_events(raw)
    spark.conf.set("spark.basketlens.hotSessionRows", "20")
    try:
        sides = salted_sides(clean, purchase_stats(clean).checkpoint())
    finally:
        spark.conf.unset("spark.basketlens.hotSessionRows")
    stored = []
    for i, side in enumerate(sides):
        t = BucketedTable(f"{workdir}/side{i}", side.schema, ("user_session", "_salt"), 8)
        t.append(side)
        stored.append(t.read(spark))
    spread = stored[0].filter("user_session = 'hot'").select(F.input_file_name().alias("f")).distinct().count()
    assert spread > 3
    first = clean.filter("event_type = 'purchase' and event_time is not null").groupBy("user_session").agg(
        F.min("event_time").alias("fb"))
    want = clean.join(first, "user_session", "left").withColumn(
        "_pre", F.col("fb").isNull() | (F.col("event_time") < F.col("fb"))).select("event_id", "_pre")
    assert as_set(flagged_pre(*stored).select("event_id", "_pre")) == as_set(want)


def test_bucketed_appends_add_up(spark, workdir):
    t = BucketedTable(f"{workdir}/t", spark.createDataFrame([], "k string, v int, day int").schema, ("k",), 4, "day")
    for day in (1, 2):
        t.append(spark.createDataFrame([("a", 1, day), (None, 2, day)], "k string, v int, day int"))
    assert as_set(t.read(spark)) == Counter({(1, "a", 1): 1, (2, "a", 1): 1, (1, None, 2): 1, (2, None, 2): 1})
    assert exchanges(t.read(spark).groupBy("k").count()) == 0


def test_counts_come_with_the_pass_that_cleans(spark, workdir):
    raw = random_events(spark, 500, 3)
    clean, counted = observed_clean(raw)
    clean.write.parquet(f"{workdir}/clean")
    n = dict(drop_reasons(counted))
    rows = raw.collect()
    assert n["raw"] == 500 and n["corrupt"] == 0
    assert n["no_user"] == sum(r.user_id is None for r in rows)
    assert n["no_session"] == sum(r.user_id is not None and r.user_session is None for r in rows)
    assert n["kept"] == spark.read.parquet(f"{workdir}/clean").count()
    assert n["kept"] + n["no_user"] + n["no_session"] + n["other_type"] == 500
    assert n["kept_untimed"] == spark.read.parquet(f"{workdir}/clean").filter("event_time is null").count()


def test_csv_counts(spark):
    path = growth.csv_with_foreign_lines(spark, SF_SMALL)
    from basketlens.sources.events import load_events_csv
    n = {r.reason: r.n for r in growth.clean_and_count(spark, load_events_csv(spark, path)).collect()}
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert n["corrupt"] == events.filter("event_id % 100 = 0").count() > 0
    assert n["raw"] == events.count() + n["corrupt"]
    assert n["kept"] == tables.clean(spark, SF_SMALL).count()
