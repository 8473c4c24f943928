"""Mixing sources to target weights (operator 1) by Sainte-Lague apportionment.

Each source's documents, in seeded order, form one stream of words that is cut
into blocks of equal size. Blocks are seats: they go to the sources by highest
quotients votes / (2 seats + 1), shard after shard, so every output shard has an
integer quota per source. Which blocks fill a quota is a seeded permutation.
"""

from __future__ import annotations

import hashlib
import heapq
import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import row_key, stored

BLOCK_WORDS = 64
# a source with fewer words than LEAST_BLOCKS whole blocks is cut finer
LEAST_BLOCKS = 64
# documents of a source whose offsets one task sums, about
BUCKET_DOCS = 4_000


def capped_targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Split ``share`` of all sizes by weight; no target above ``most`` times its
    size, the excess shared again by weight until none is above."""
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    targets = [0.0] * len(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = unit * weights[i]
            break
        for i in over:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def seats(votes: list[float], house: int, most: list[int]) -> list[int]:
    """Sainte-Lague: ``house`` seats by highest quotients votes / (2 seats + 1),
    ties to the first; no more than ``most`` each. All seats above a divisor are
    given at once, the last few one by one. Allocations grow with the house."""
    def by_divisor(d):
        return [min(m, math.floor(v / d + 0.5)) for v, m in zip(votes, most)]

    house = min(house, sum(m for v, m in zip(votes, most) if v > 0))
    if house <= 0:
        return [0] * len(votes)
    low, high = 1e-9, 4 * max(votes) + 1
    for _ in range(200):
        middle = (low + high) / 2
        if sum(by_divisor(middle)) > house:
            low = middle
        else:
            high = middle
    given = by_divisor(high)
    queue = [(-v / (2 * g + 1), i) for i, (v, g, m) in enumerate(zip(votes, given, most)) if g < m and v > 0]
    heapq.heapify(queue)
    for _ in range(house - sum(given)):
        _, i = heapq.heappop(queue)
        given[i] += 1
        if given[i] < most[i]:
            heapq.heappush(queue, (-votes[i] / (2 * given[i] + 1), i))
    return given


def _permutation(seed: int, source: str | None, n: int) -> tuple[int, int]:
    """a, b of the seeded permutation k -> (a k + b) mod n; a k stays in 63 bits."""
    raw = hashlib.blake2b(repr((seed, source)).encode(), digest_size=16).digest()
    b = int.from_bytes(raw[:8], "little") % n
    a = int.from_bytes(raw[8:], "little") % max(1, min(n, (1 << 62) // n)) or 1
    while math.gcd(a, n) > 1:
        a += 1
    return a, b


def word_sizes(docs: DataFrame) -> DataFrame:
    """r1, r2 (row key), doc_id, source, size: words of the whole text, null 0."""
    def count(batches):
        for batch in batches:
            sizes = []
            texts = batch.column("text")
            for at in range(0, len(texts), 256):
                # bytes.split() without arguments splits at the six ASCII space characters
                sizes += [len(t.split()) if t else 0 for t in texts.slice(at, 256).to_pylist()]
            yield batch.drop_columns(["text"]).append_column("size", pa.array(sizes, pa.int64()))

    r1, r2 = row_key("doc_id", "source", "text")
    return docs.select(r1.alias("r1"), r2.alias("r2"), F.col("doc_id").cast("long"), "source",
                       F.col("text").cast("binary").alias("text")).mapInArrow(
        count, "r1 long, r2 long, doc_id long, source string, size long")


def source_plan(sizes: DataFrame, weights: tuple, share: float, most: float, shards: int, seed: int):
    """One row per source, as a list: its target, blocks, and seats per shard.

    The list has a row per source, not per document; sources are named data
    sets, so it is small next to any document table."""
    found = sizes.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found = sorted(((r["source"], r["size"]) for r in found), key=lambda r: (r[0] is None, r[0] or ""))
    targets = capped_targets([s for _, s in found], [weights[i % len(weights)] for i in range(len(found))],
                             share, most)
    width = [max(1, min(BLOCK_WORDS, size // LEAST_BLOCKS)) for _, size in found]
    blocks = [-(-size // w) for (_, size), w in zip(found, width)]
    cap = [math.floor(most * n) for n in blocks]
    # a target at its cap takes every block ``most`` times
    votes = [float(c) if t >= most * size > 0 else t / w
             for (_, size), t, w, c in zip(found, targets, width, cap)]
    house = round(sum(votes))
    grown = [seats(votes, house * (h + 1) // shards, cap) for h in range(shards)]
    plan = []
    for i, (source, size) in enumerate(found):
        n, q = blocks[i], grown[-1][i]
        a, b = _permutation(seed, source, n) if n else (1, 0)
        plan.append((i, source, size, targets[i], width[i], max(n, 1), a, b, q // n if n else 0,
                     q % n if n else 0, [g[i] for g in grown]))
    return plan


PLAN = ("sid int, source string, source_size long, target double, width long, blocks long, a long, b long, "
        "whole long, extra long, quota_to array<long>")


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, most: float = 2,
        shards: int = 16, seed: int = 17) -> DataFrame:
    """r1, r2, doc_id, source, size, source_size, target, taken, shard per row of
    ``docs`` (doc_id, source, text).

    ``taken``: words of the document that the mix takes, repeats counted; a block
    is taken at most ``most`` times (a whole number). ``shard``: where the first
    of them goes (null if none is taken). Sources by code point, null last, weigh
    ``weights`` in turn. Documents without words and null texts take nothing;
    repeated rows are documents of their own; an empty table gives no rows. The
    same rows and seed give the same mix, however they are partitioned.
    """
    spark = docs.sparkSession
    sizes = stored(word_sizes(docs), "mix-sizes")
    plan = spark.createDataFrame(source_plan(sizes, weights, share, most, shards, seed), PLAN)
    buckets = max(1, sizes.count() // BUCKET_DOCS)
    order = F.xxhash64(F.lit(seed), "r1", "r2")
    rows = (sizes.join(plan.withColumnRenamed("source", "s"), sizes["source"].eqNullSafe(F.col("s"))).drop("s")
            .withColumn("u", order).withColumn("bucket", F.pmod("u", F.lit(buckets)).cast("int")))
    # offsets in the source's stream: sums per bucket, then inside a bucket
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("sid").orderBy("bucket")
    sums = sums.select("sid", "bucket", (F.sum("n").over(before) - F.col("n")).alias("bucket_start"))
    inside = Window.partitionBy("sid", "bucket").orderBy("u", "r1", "r2").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.join(sums, ["sid", "bucket"])
              .withColumn("start", F.col("bucket_start") + F.sum("size").over(inside) - F.col("size")))
    rank = "(a * k + b) % blocks"
    parts = placed.withColumn("parts", F.expr(f"""if(size = 0, array(), transform(
        sequence(start div width, (start + size - 1) div width),
        k -> struct(least((k + 1) * width, start + size) - greatest(k * width, start) as words, {rank} as rank)))"""))
    taken = parts.withColumn("taken", F.expr(
        "aggregate(parts, 0L, (t, x) -> t + x.words * (whole + if(x.rank < extra, 1, 0)))"))
    first = F.expr("get(filter(parts, x -> whole > 0 or x.rank < extra), 0).rank")
    return taken.withColumn("first", first).select(
        "r1", "r2", "doc_id", "source", "size", "source_size", "target", "taken",
        F.expr("if(first is null, null, size(filter(quota_to, q -> q <= first)))").cast("int").alias("shard"))


def mixed_documents(docs: DataFrame, even: bool = False, **settings) -> DataFrame:
    """The rows of ``docs`` that the mix takes, whole, with all their columns: a
    document comes as often as its taken words fill it (0 to ``most`` times).

    A part of a document counts by rounding, or with ``even`` as one more copy
    with a chance of that part, by a seeded hash: a source then has its taken
    words on average whatever the length of its documents. Rounding gives long
    documents, whose parts are all near target / source_size, the same count.
    """
    r1, r2 = row_key("doc_id", "source", "text")
    order = Window.partitionBy("__r1", "__r2").orderBy(F.lit(1))
    copies = (mix(docs, **settings).filter("size > 0")
              .select(F.col("r1").alias("__r1"), F.col("r2").alias("__r2"), "size", "taken"))
    copies = copies.withColumn("__nth", F.row_number().over(
        Window.partitionBy("__r1", "__r2").orderBy(F.col("taken").desc())))
    if even:
        draw = F.xxhash64(F.lit("copies"), F.lit(settings.get("seed", 17)), "__r1", "__r2", "__nth")
        count = F.expr("taken div size") + F.when(F.pmod(draw, F.col("size")) < F.expr("taken % size"), 1).otherwise(0)
    else:
        count = F.round(F.col("taken") / F.col("size"))
    copies = copies.select("__r1", "__r2", "__nth", count.cast("int").alias("__copies"))
    rows = docs.withColumn("__r1", r1).withColumn("__r2", r2).withColumn("__nth", F.row_number().over(order))
    return (rows.join(copies, ["__r1", "__r2", "__nth"]).filter("__copies > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*(F.col(f"`{c}`") for c in docs.columns)))
