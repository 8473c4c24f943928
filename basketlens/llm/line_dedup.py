"""Reversible line dedup (operator 8).

The exact part is a reference-count table: for each line key the number of
documents that hold it. Over it, each shard of the key space has a cuckoo
filter of the keys at or above the threshold. Inserting or deleting documents
changes counts, and only keys that cross the threshold enter or leave their
shard's filter. Every line is looked up in its shard's filter first; only lines the
filter lets through meet the exact table, which decides. A shard whose lines are too
many for one task (a line that a third of the corpus repeats) has copies of its
filter, and its lines are spread over them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import SPACE_CHARS, lookup_join, row_key, stored
from basketlens.llm.pretokens import rows_of

# lines that meet one copy of a shard's filter, about
SHARD_LINES = 100_000
# shards; the table of their copies (a row per shard) is broadcast
MIN_SHARDS, MAX_SHARDS = 64, 65_536


def line_key(line: str) -> tuple[int, int] | None:
    """128 bits of the stripped line with A-Z lowered; None for an empty key."""
    key = line.strip(SPACE_CHARS).encode().lower()
    if not key:
        return None
    digest = hashlib.blake2b(key, digest_size=16).digest()
    return (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; supports add, remove and lookup.

    A key (its second hash) has a fingerprint and two buckets; a full pair of
    buckets pushes a fingerprint on to its other bucket. ``add`` is False when
    no place is found: the filter must be built anew, larger.
    """

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(keys * 1.25 / 4).bit_length())
        return cls(np.zeros((buckets, 4), np.uint16))

    @classmethod
    def read(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, 4).copy())

    def places(self, h: np.ndarray):
        h = np.asarray(h).astype(np.int64).view(np.uint64)
        mark = (h & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        mask = np.uint64(len(self.slots) - 1)
        one = (h >> np.uint64(16)) & mask
        return mark, one, one ^ self.step(mark)

    def step(self, mark):
        spread = np.asarray(mark).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
        return spread & np.uint64(len(self.slots) - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(h)
        return ((self.slots[one] == mark[:, None]) | (self.slots[two] == mark[:, None])).any(axis=1)

    def add(self, h: np.ndarray) -> bool:
        turn = 0
        for mark, one, two in zip(*self.places(h)):
            for at in (one, two):
                free = np.flatnonzero(self.slots[at] == 0)
                if len(free):
                    self.slots[at, free[0]] = mark
                    break
            else:
                at = two
                for _ in range(500):
                    turn = (turn + 1) & 3
                    self.slots[at, turn], mark = mark, self.slots[at, turn]
                    at = at ^ self.step(mark)
                    free = np.flatnonzero(self.slots[at] == 0)
                    if len(free):
                        self.slots[at, free[0]] = mark
                        break
                else:
                    return False
        return True

    def remove(self, h: np.ndarray) -> None:
        for mark, one, two in zip(*self.places(h)):
            for at in (one, two):
                found = np.flatnonzero(self.slots[at] == mark)
                if len(found):
                    self.slots[at, found[0]] = 0
                    break


def _document_keys(batches):
    """(h1, h2, n): keys of the texts, each counted once a text, summed per batch."""
    for batch in batches:
        counts: dict = {}
        for (texts,) in rows_of(batch):
            for text in texts:
                for key in {line_key(x) for x in (text or "").split("\n")}:
                    if key:
                        counts[key] = counts.get(key, 0) + 1
        h1, h2 = zip(*counts) if counts else ((), ())
        yield pa.record_batch([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                               pa.array(counts.values(), pa.int64())], ["h1", "h2", "n"])


def _lines(batches):
    """(r1, r2, h1, h2, at): every key of a text and the positions of its lines."""
    schema = pa.schema([(c, pa.int64()) for c in ("r1", "r2", "h1", "h2")] + [("at", pa.list_(pa.int32()))])
    for batch in batches:
        for r1, r2, texts in rows_of(batch):
            cols: tuple = ([], [], [], [], [])
            for a, b, text in zip(r1, r2, texts):
                places: dict = {}
                for pos, line in enumerate((text or "").split("\n")):
                    if key := line_key(line):
                        places.setdefault(key, []).append(pos)
                for key, at in places.items():
                    for c, v in zip(cols, (a, b, *key, at)):
                        c.append(v)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _updated_filter(key, old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after its keys' crossings; built anew from all its
    frequent keys where there is none yet or it has no more room."""
    now, was = keys["now"].to_numpy(bool), keys["was"].to_numpy(bool)
    h = keys["h2"].to_numpy(np.int64)
    table = CuckooFilter.read(old["slots"].iloc[0]) if len(old) else None
    if table is not None:
        table.remove(h[was & ~now])
    if table is None or not table.add(h[now & ~was]):
        size = int(now.sum())
        table = CuckooFilter.sized(size)
        while not table.add(h[now]):
            size *= 2
            table = CuckooFilter.sized(size)
    return pd.DataFrame({"shard": [key[0]], "slots": [table.slots.tobytes()]})


def _filtered(key, lines: pa.Table, filters: pa.Table) -> pa.Table:
    """A shard's lines that its filter lets through."""
    lines = lines.drop_columns(["shard", "copy"])
    if not filters.num_rows:
        return lines.slice(0, 0)
    table = CuckooFilter.read(filters["slots"][0].as_py())
    return lines.filter(pa.array(table.has(lines["h2"].to_numpy())))


class LineIndex:
    """Line counts and filters over the documents inserted so far.

    ``insert`` and ``delete`` return the next version; the versions are Parquet
    tables in the shared folder, so an index survives lost executors. Deleting
    what was inserted gives back the earlier counts and decisions. ``rows`` counts
    the inserted rows by their key: deleting a row (doc_id and text) more often than
    it was inserted raises ValueError and changes nothing.
    """

    def __init__(self, spark: SparkSession, threshold: int = 10, refs: DataFrame | None = None,
                 filters: DataFrame | None = None, shards: int = 0, rows: DataFrame | None = None):
        self.spark, self.threshold = spark, threshold
        self.refs, self.filters, self.shards, self.rows = refs, filters, shards, rows

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        return self._changed(docs, -1)

    def _row_counts(self, docs: DataFrame, sign: int) -> DataFrame:
        r1, r2 = row_key("doc_id", "text")
        delta = docs.select(r1.alias("r1"), r2.alias("r2"), F.lit(sign).cast("long").alias("n"))
        both = delta if self.rows is None else delta.unionByName(self.rows)
        rows = stored(both.groupBy("r1", "r2").agg(F.sum("n").alias("n")).filter("n <> 0"), "line-rows")
        if sign < 0 and not rows.filter("n < 0").isEmpty():
            raise ValueError("documents were deleted that had not been inserted")
        return rows

    def _changed(self, docs: DataFrame, sign: int) -> LineIndex:
        rows = self._row_counts(docs, sign)
        delta = docs.select("text").mapInArrow(_document_keys, "h1 long, h2 long, n long").withColumn(
            "n", F.col("n") * sign).withColumn("old", F.lit(0).cast("long"))
        both = delta if self.refs is None else delta.unionByName(
            self.refs.select("h1", "h2", "n", F.col("n").alias("old")))
        enough = F.lit(self.threshold)
        refs = stored(both.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.sum("old").alias("old"))
                      .select("h1", "h2", "n", (F.col("old") >= enough).alias("was"),
                              (F.col("n") >= enough).alias("now")), "line-refs")
        lines = refs.agg(F.sum("n")).first()[0] or 0
        shards = min(MAX_SHARDS, max(MIN_SHARDS, -(-lines // SHARD_LINES)))
        keep = self.filters is not None and shards <= 2 * self.shards
        shards = self.shards if keep else shards
        changed = refs.filter("was or now").select(
            _shard(shards), "h1", "h2", "now", "was" if keep else F.lit(False).alias("was"))
        old = self.filters if keep else self.spark.createDataFrame([], "shard int, slots binary")
        filters = stored(old.groupBy("shard").cogroup(changed.groupBy("shard"))
                         .applyInPandas(_updated_filter, "shard int, slots binary"), "line-filters")
        return LineIndex(self.spark, self.threshold, refs.filter("n > 0").select("h1", "h2", "n"),
                         filters, shards, rows)

    def passed(self, docs: DataFrame) -> DataFrame:
        """(r1, r2, h1, h2, at) of the keys of ``docs`` (r1, r2, text) that the
        filters let through: those of frequent lines and a few others."""
        lines = docs.select("r1", "r2", "text").mapInArrow(
            _lines, "r1 long, r2 long, h1 long, h2 long, at array<int>").withColumn("shard", _shard(self.shards, None))
        # copies by the lines of the index: a row per shard, at most MAX_SHARDS
        copies = F.broadcast(self.refs.groupBy(_shard(self.shards)).agg(
            F.ceil(F.sum("n") / SHARD_LINES).cast("int").alias("copies")))
        spread = lines.join(copies, "shard").withColumn(
            "copy", F.pmod(F.xxhash64("r1", "r2"), F.col("copies")).cast("int")).drop("copies")
        filters = self.filters.join(copies, "shard").select(
            "shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "slots")
        return (spread.groupBy("shard", "copy").cogroup(filters.groupBy("shard", "copy"))
                .applyInArrow(_filtered, "r1 long, r2 long, h1 long, h2 long, at array<int>"))

    def _frequent_lines(self, docs: DataFrame) -> DataFrame:
        """(r1, r2, drop): per row key, the positions of its frequent lines."""
        exact = self.refs.filter(F.col("n") >= self.threshold)
        found = lookup_join(stored(self.passed(docs), "line-passed"), exact, ["h1", "h2"], "n", how="left_semi")
        return found.groupBy("r1", "r2").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("drop"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` with kept_text, n_lines, n_dropped: all lines whose key is in
        at least ``threshold`` inserted documents leave.

        Null and empty texts are one empty line, which has no key and stays.
        Rows count as documents: a repeated row counts each time and gets its
        result each time. All columns of ``docs`` stay, except that columns named
        like the three results are replaced.
        """
        new = ["kept_text", "n_lines", "n_dropped"]
        rows = docs.drop(*new)
        r1, r2 = row_key("doc_id", "text")
        drops = self._frequent_lines(docs.select(r1.alias("r1"), r2.alias("r2"), "text"))
        drops = drops.select(F.col("r1").alias("__r1"), F.col("r2").alias("__r2"), F.col("drop").alias("__drop"))
        without = F.pandas_udf(_without, "kept_text string, n_lines long, n_dropped long")
        return (rows.withColumn("__r1", r1).withColumn("__r2", r2)
                .join(drops, ["__r1", "__r2"], "left")
                .withColumn("__kept", without(F.col("text"), F.col("__drop")))
                .select(*(F.col(f"`{c}`") for c in rows.columns), *(F.col(f"__kept.{c}") for c in new)))


def _shard(shards: int, name: str | None = "shard") -> Column:
    column = F.pmod(F.col("h1"), F.lit(shards)).cast("int")
    return column.alias(name) if name else column


def _without(text: pd.Series, drop: pd.Series) -> pd.DataFrame:
    kept, n_lines, n_dropped = [], [], []
    for t, positions in zip(text, drop):
        lines = (t or "").split("\n")
        gone = set() if positions is None else set(positions)
        kept.append("\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else t or "")
        n_lines.append(len(lines))
        n_dropped.append(len(gone))
    return pd.DataFrame({"kept_text": kept, "n_lines": n_lines, "n_dropped": n_dropped})


def dedup_lines(docs: DataFrame, threshold: int = 10) -> DataFrame:
    """``docs`` less the lines found in at least ``threshold`` of its documents."""
    return LineIndex(docs.sparkSession, threshold).insert(docs).apply(docs)
