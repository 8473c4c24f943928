"""Inputs that differ from what is expected, changed inputs, and lagging ones."""

from __future__ import annotations

import json
import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketlens.plans import tables
from basketlens.session import scratch_root
from basketlens.sources.events import load_events_csv
from basketlens.sources.messages import decode_session_messages
from basketlens.streaming.threshold import buffer_by_session
from conftest import F1_CSV, SF_SMALL


def _write(folder, name, text):
    path = Path(folder) / name
    path.write_text(text)
    return str(path)


def _reordered(csv_text, order):
    rows = [line.split(",") for line in csv_text.strip().split("\n")]
    at = [rows[0].index(c) for c in order]
    return "\n".join(",".join(r[i] for i in at) for r in rows) + "\n"


def test_csv_columns_are_matched_by_name(spark, workdir):
    plain = load_events_csv(spark, _write(workdir, "plain.csv", F1_CSV))
    order = ["user_session", "price", "brand", "event_type", "category_id", "user_id", "category_code",
             "event_time", "product_id"]
    other = load_events_csv(spark, _write(workdir, "other.csv", _reordered(F1_CSV, order)))
    assert plain.drop("event_id").collect() == other.drop("event_id").collect()
    fewer = load_events_csv(spark, _write(workdir, "fewer.csv", _reordered(F1_CSV, [c for c in order if c != "price"])))
    assert fewer.filter("price is not null").count() == 0 and fewer.count() == plain.count()


def test_csv_lines_that_are_no_records_are_kept(spark, workdir):
    text = F1_CSV + "only,three,fields\n"
    rows = load_events_csv(spark, _write(workdir, "bad.csv", text)).filter("corrupt_record is not null").collect()
    assert [r.corrupt_record for r in rows] == ["only,three,fields"]


def test_csv_files_with_another_header_fail(spark, workdir):
    folder = Path(workdir) / "csv"
    folder.mkdir()
    _write(folder, "a.csv", F1_CSV)
    _write(folder, "b.csv", _reordered(F1_CSV, list(reversed(F1_CSV.split("\n")[0].split(",")))))
    with pytest.raises(Exception, match="header|HEADER|schema"):
        load_events_csv(spark, str(folder)).collect()


def test_wrong_typed_fields_are_not_valid(spark):
    good = {"user_session": "s", "num_views": 3, "avg_price": 12.5, "main_category": "toys"}
    lines = [good, dict(good, num_views="abc"), dict(good, avg_price="12.5"), dict(good, extra=1)]
    df = spark.createDataFrame([(json.dumps(x),) for x in lines] + [("[1",), ("null",)], "value string")
    got = [r["_valid"] for r in decode_session_messages(df).collect()]
    assert got == [True, False, False, True, False, False]


def test_derived_tables_follow_the_data(spark, workdir):
    base = f"{workdir}/data"
    os.makedirs(base)
    for t in ("events", "part"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{base}/{t}.parquet")
    before = tables.raw_events(spark, base).filter("category_code is not null").count()
    events = spark.read.parquet(f"{base}/events.parquet")
    known = spark.read.parquet(f"{base}/part.parquet").select("p_partkey")
    used = events.select(F.get_json_object("props", "$.k").cast("long").alias("p_partkey"))
    new = known.join(used, "p_partkey", "left_anti").filter("p_partkey % 10 > 0").limit(5).collect()
    assert new
    keys = F.array(*[F.lit(r.p_partkey) for r in new])
    more = events.limit(50).withColumn("props", F.to_json(F.struct(
        F.element_at(keys, (F.pmod("event_id", F.lit(len(new))) + 1).cast("int")).alias("k"))))
    events.unionByName(more).write.parquet(f"{workdir}/grown")
    os.remove(f"{base}/events.parquet")
    shutil.move(f"{workdir}/grown", f"{base}/events.parquet")
    spark.catalog.clearCache()
    assert tables.raw_events(spark, base).filter("category_code is not null").count() == before + 50


def test_scratch_root_is_the_folder_that_was_set(spark, workdir):
    sc = spark.sparkContext
    old = scratch_root(spark)
    sc.setCheckpointDir(f"{workdir}/mine")
    try:
        assert scratch_root(spark).endswith(f"{workdir}/mine")
    finally:
        sc.setCheckpointDir(old)
    assert scratch_root(spark).split(":")[-1] == old.split(":")[-1]


def test_threshold_buffer_loses_nothing_of_a_lagging_source(spark, workdir):
    """Three micro-batches; the last has messages that arrived ten minutes before
    the others."""
    folder = Path(workdir) / "in"
    folder.mkdir()
    batches = [[("a", "12:00:00"), ("b", "12:00:01")], [("a", "12:00:05"), ("c", "12:01:00")],
               [("late", "11:50:00"), ("late", "11:50:01"), ("b", "11:50:02")]]
    for i, rows in enumerate(batches):
        path = folder / f"m{i}.json"
        path.write_text("\n".join(json.dumps({"value": json.dumps({"user_session": s, "num_views": i}),
                                              "arrival": f"2024-01-01T{t}Z"}) for s, t in rows) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    msgs = (spark.readStream.schema("value string, arrival timestamp").option("maxFilesPerTrigger", 1)
            .json(str(folder)))
    from basketlens.session import settings
    from basketlens.streaming.threshold import rocksdb_state
    with settings(spark, rocksdb_state(spark)):
        q = (buffer_by_session(msgs, 2).writeStream.format("parquet").option("path", f"{workdir}/out")
             .option("checkpointLocation", f"{workdir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.read.parquet(f"{workdir}/out").collect()
    assert {(r.user_session, r.n_messages, json.loads(r.value)["num_views"]) for r in rows} == {
        ("a", 2, 0), ("late", 2, 2), ("b", 2, 0)}
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    assert dropped == 0
