"""Minimum-cost-flow resharding (operator 3).

Documents lie in old shards, each cut into blocks by size class. New shards get
row capacities (counts at most one apart). A min-cost flow from the blocks'
rows to the capacities, where staying is free and moving a row costs its block's
mean bytes, gives the transfers that move the fewest bytes, counted in block means;
the files of blocks that lose rows are rewritten, rows that stay included, the
others are left as they are.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.common import delete_at_exit, row_key
from basketlens.session import scratch_path

# rows and bytes of one file, about, and so of one rank window
PART_ROWS = 50_000
PART_BYTES = 64 << 20


class Block(NamedTuple):
    shard: int
    size_class: int
    rows: int
    bytes: int


class Transfer(NamedTuple):
    shard: int
    size_class: int
    low: int
    high: int
    to: int


def min_cost_flow(n: int, edges: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each (from, to, capacity, cost) edge that carries the most from
    ``source`` to ``sink`` at the least cost: shortest augmenting paths with
    potentials (costs must not be negative)."""
    graph: list[list[int]] = [[] for _ in range(n)]
    head, room, cost = [], [], []
    for a, b, c, w in edges:
        graph[a].append(len(head))
        head.append(b), room.append(c), cost.append(w)
        graph[b].append(len(head))
        head.append(a), room.append(0), cost.append(-w)
    potential = [0] * n
    while True:
        far = [None] * n
        far[source], via, queue = 0, [-1] * n, [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in graph[a]:
                if room[e]:
                    b, new = head[e], d + cost[e] + potential[a] - potential[head[e]]
                    if far[b] is None or new < far[b]:
                        far[b], via[b] = new, e
                        heapq.heappush(queue, (new, b))
        if far[sink] is None:
            return room[1::2]
        for a in range(n):
            if far[a] is not None:
                potential[a] += far[a]
        path, a = [], sink
        while a != source:
            path.append(via[a])
            a = head[via[a] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push


def plan_transfers(blocks: list[Block], n_new: int) -> list[Transfer]:
    """Row ranges of blocks that leave their shard. Ranks [low, high) of a block
    go to shard ``to``; ranks before the first range stay.

    The graph has a node per block (shards x size classes, whatever the number
    of rows), per new shard, a pool that all moved rows pass, and a node that
    hands out the one extra row some shards may have.
    """
    total = sum(b.rows for b in blocks)
    first, pool = 1 + len(blocks), 1 + len(blocks) + n_new
    extra, sink = pool + 1, pool + 2
    edges = []
    for i, b in enumerate(blocks):
        edges.append((0, 1 + i, b.rows, 0))
        if b.shard < n_new:
            edges.append((1 + i, first + b.shard, b.rows, 0))
        edges.append((1 + i, pool, b.rows, max(1, 1000 * b.bytes // max(1, b.rows))))
    at_pool = len(edges)
    for j in range(n_new):
        edges.append((pool, first + j, total, 0))
    for j in range(n_new):
        edges += [(first + j, sink, total // n_new, 0), (first + j, extra, 1, 0)]
    edges.append((extra, sink, total % n_new, 0))
    flow = min_cost_flow(sink + 1, edges, 0, sink)
    leaving = [flow[k] for k in range(at_pool) if edges[k][1] == pool]
    wanted = [[j, flow[at_pool + j]] for j in range(n_new) if flow[at_pool + j]]
    transfers = []
    for b, n in zip(blocks, leaving):
        low = b.rows - n
        while low < b.rows:
            take = min(b.rows - low, wanted[0][1])
            transfers.append(Transfer(b.shard, b.size_class, low, low + take, wanted[0][0]))
            low += take
            wanted[0][1] -= take
            if not wanted[0][1]:
                wanted.pop(0)
    return transfers


def _inner_rank(keys: list[str], order: list[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys, "part").orderBy(*order)) - 1


def ranked(rows: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``rows`` with a gapless rank from 0 within ``keys``: counts per (keys,
    part) give each part its offset, so one window holds one part's rows only."""
    counts = rows.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*keys).orderBy("part")
    offsets = counts.select(*keys, "part", (F.sum("n").over(before) - F.col("n")).alias("offset"))
    return (rows.join(offsets, [*keys, "part"])
            .withColumn(name, F.col("offset") + _inner_rank(keys, order)).drop("offset"))


def write_layout(docs: DataFrame, path: str, n_shards: int) -> T.StructType:
    """Write ``docs`` (doc_id, text, more columns) as ``path``/shard=/size_class=;
    the layout's columns.

    A document's first shard is its id's checksum; its size class is twice the
    binary logarithm of its bytes. ``part`` cuts every block by a hash of the row
    into files of PART_ROWS rows and PART_BYTES at most, about: the totals per
    size class (some 60 at most) tell how many parts a class needs.
    """
    r1, r2 = row_key("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    size_class = F.floor(2 * F.log2(size)).cast("int")
    totals = docs.select(size_class.alias("c"), size.alias("size")).groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect()
    parts = F.lit(1)
    for r in totals:
        need = max(r["n"] // (n_shards * PART_ROWS), r["bytes"] // (n_shards * PART_BYTES))
        if need > 1:
            parts = F.when(F.col("size_class") == r["c"], F.lit(need)).otherwise(parts)
    shard = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n_shards))
    rows = (docs.withColumn("size", size).withColumn("shard", shard.cast("int"))
            .withColumn("size_class", size_class)
            .withColumn("r1", r1).withColumn("r2", r2).withColumn("part", F.pmod("r2", parts).cast("int")))
    (rows.repartition("shard", "size_class", "part")
     .write.partitionBy("shard", "size_class").option("compression", "zstd").parquet(path))
    return rows.schema


def reshard(spark: SparkSession, path: str, moved_path: str, n_new: int, schema: T.StructType) -> DataFrame:
    """Deal the layout at ``path`` (with columns ``schema``) to ``n_new`` shards; the new layout's rows.

    Blocks without transfers keep their files. The others are read, their rows
    ranked, and the block's rows are written below ``moved_path`` with their new
    shard; the old files of just those blocks are no longer part of the layout.
    """
    old = spark.read.schema(schema).parquet(path)
    blocks = [Block(r["shard"], r["size_class"], r["n"], r["bytes"]) for r in
              old.groupBy("shard", "size_class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
              .orderBy("shard", "size_class").collect()]
    transfers = plan_transfers(blocks, n_new)
    touched = sorted({(t.shard, t.size_class) for t in transfers})
    if not touched:
        return old
    names = F.struct("shard", "size_class")
    hit = names.isin([F.struct(F.lit(s).alias("shard"), F.lit(c).alias("size_class")) for s, c in touched])
    moves = spark.createDataFrame([tuple(t) for t in transfers],
                                  "from int, class int, low long, high long, to int")
    rows = ranked(old.filter(hit), ["shard", "size_class"], [F.col("r1"), F.col("r2")], "rank")
    # a row meets at most one range of its block; there are at most blocks + n_new ranges
    placed = (rows.join(F.broadcast(moves), (rows["shard"] == moves["from"])
                        & (rows["size_class"] == moves["class"])
                        & (rows["rank"] >= moves["low"]) & (rows["rank"] < moves["high"]), "left")
              .withColumn("shard", F.coalesce("to", "shard")).drop("rank", "from", "class", "low", "high", "to"))
    (placed.repartition("shard", "part").write.partitionBy("shard", "size_class")
     .option("compression", "zstd").parquet(moved_path))
    columns = old.columns
    return old.filter(~hit).select(*columns).unionByName(spark.read.schema(schema).parquet(moved_path).select(*columns))


def shard_slots(layout: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0 per shard) of a layout,
    read from its files. Order within a shard: part, then row key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = layout.select("doc_id", "size", F.crc32(text.cast("binary")).alias("text_crc32"),
                         "shard", "part", "r1", "r2")
    return (ranked(rows, ["shard"], [F.col("r1"), F.col("r2")], "slot")
            .select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long")))


def reshard_documents(docs: DataFrame, n_old: int = 12, n_new: int = 16) -> DataFrame:
    """Lay ``docs`` (doc_id, text) out in ``n_old`` shards, move to ``n_new`` and
    return the new layout (``write_layout``'s columns).

    Law ``rows``: counts at most one apart. Equal texts are not kept together (a
    text that a third of all rows share fits no shard). Null text: size 1; null
    doc_id: a shard of its own choice like any other; repeated rows are rows of
    their own; an empty table gives an empty layout.
    """
    spark = docs.sparkSession
    old, moved = scratch_path(spark, "shards"), scratch_path(spark, "shards-moved")
    schema = write_layout(docs.select(F.col("doc_id").cast("long"), "text"), old, n_old)
    delete_at_exit(spark, old)
    delete_at_exit(spark, moved)
    return reshard(spark, old, moved, n_new, schema)
