"""Cross-polytope nearest neighbours (operator 7).

Vectors are brought to the unit sphere, turned by fast Hadamard pseudo-rotations
and hashed to the nearest signed axis. Several tables, each probed at the query's
best axes or tuples of axes, collect candidates; those are ranked by the inner
product of the original vectors in double precision. A longer vector is near at a
wider angle, so vectors are kept by norm range, the longer ones probed deeper.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import stored

# Each query is held against a sample of this many vectors first: the sample's k
# nearest are found vectors too, so a query never has fewer than k.
SAMPLE = 512
# vectors of a bucket that one task ranks; larger buckets are cut into chunks
CHUNK = 4096

FOUND = "q1 long, q2 long, score double, h1 long, h2 long, ids array<bigint>"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix, in n log n steps."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(unit: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and Hadamard transform."""
    signs = np.random.RandomState(seed).choice([-1.0, 1.0], (3, unit.shape[1]))
    for s in signs:
        unit = hadamard(unit * s)
    return unit


def directions(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, padded to a power of two."""
    n, d = vectors.shape
    out = np.zeros((n, 1 << int(d).bit_length()))
    out[:, :d] = vectors / np.abs(vectors).max(axis=1)[:, None]
    return out / np.sqrt((out * out).sum(axis=1))[:, None]


def probe_counts(sizes: dict[int, int], probe: int, total: int) -> dict[int, int]:
    """Buckets to probe by norm range (in half powers of two, with its number of
    vectors): ``probe`` up to a reference, above it more as the norm grows, 0 for
    ranges that are searched whole. The reference is the lowest range, from the
    median up, that at most doubles the share of vectors that a table gives."""
    def counts(at):
        return {g: probe if g <= at else min(total, round(probe * 2 ** min(64, (g - at) / 2))) for g in sizes}

    order, half, passed = sorted(sizes), sum(sizes.values()) / 2, 0
    for at in order:
        passed += sizes[at]
        found = counts(at)
        if passed >= half and sum(n * found[g] for g, n in sizes.items()) <= 4 * half * probe:
            break
    return {g: 0 if c > probe and (c >= total or sizes[g] <= max(c, CHUNK)) else c for g, c in found.items()}


def buckets(unit: np.ndarray, table: int, hashes: int) -> np.ndarray:
    """Each row's bucket: the signed axes nearest after ``hashes`` rotations."""
    code = np.zeros(len(unit), np.int64)
    for k in range(hashes):
        y = rotated(unit, 1000 * table + k)
        axis = np.abs(y).argmax(axis=1)
        code = code * (2 * y.shape[1]) + 2 * axis + (y[np.arange(len(y)), axis] < 0)
    return code


def probes(unit: np.ndarray, table: int, hashes: int, count: int) -> np.ndarray:
    """Each row's ``count`` best buckets: axes by falling coordinate; with more
    hashes, tuples by the falling sum of their coordinates."""
    rows = np.arange(len(unit))[:, None]
    code, score = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
    for k in range(hashes):
        y = rotated(unit, 1000 * table + k)
        both = np.empty((len(y), 2 * y.shape[1]))
        both[:, 0::2], both[:, 1::2] = y, -y
        best = np.argsort(-both, axis=1, kind="stable")[:, :count]
        new = score[:, :, None] + both[rows, best][:, None, :]
        codes = code[:, :, None] * both.shape[1] + best[:, None, :]
        new, codes = new.reshape(len(y), -1), codes.reshape(len(y), -1)
        keep = np.argsort(-new, axis=1, kind="stable")[:, :count]
        score, code = new[rows, keep], codes[rows, keep]
    return code


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in one order whatever the batch."""
    return (q * x).sum(axis=1)


def usable_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, v (array of double): not null or zero, all components finite, and
    of the length that most vectors of the table have."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.select(F.col("vec_id").cast("long"), v.alias("v")).filter(F.col("v").isNotNull() & good)
    rows = rows.filter(F.exists("v", lambda x: x != 0) & F.col("vec_id").isNotNull())
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (common["d"] if common else 0))


def _distinct(rows: DataFrame, keep: int) -> DataFrame:
    """h1, h2, v, ids: distinct vectors with their ``keep`` smallest ids. Larger
    ids of an equal vector can't be among the ``keep`` nearest; the rank filter
    runs before the shuffle, so a vector that a third of all rows share is cut in
    every task."""
    hashed = rows.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit("second"), "v"))
    ranked = hashed.withColumn("n", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id")))
    return ranked.filter(F.col("n") <= keep).groupBy("h1", "h2").agg(
        F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def nearest(vectors: DataFrame, is_query, k: int = 20, tables: int = 8, probe: int = 20,
            hashes: int = 1) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` (vec_id,
    embedding) that meets ``is_query``, the ``k`` nearest other rows found.

    Nearness is the largest inner product, ties to the smaller vec_id. Recall
    depends on ``tables`` and ``probe``; a table has (2 d')^``hashes`` buckets, d'
    the padded length: raise ``hashes`` by one when buckets hold more than some
    10,000 vectors. Vectors much longer than most are probed deeper, the few longest
    searched whole. Vectors null, zero, or with null or non-finite components
    take no part, nor rows without vec_id. Rows that repeat a vec_id are vectors
    of their own; a query leaves out all rows with its id.
    """
    spark = vectors.sparkSession
    usable = usable_vectors(vectors)
    # own ids are left out in the end, so one id more than k is kept
    norm = F.log2(F.expr("aggregate(v, 0D, (s, x) -> s + x * x)"))
    norm = F.floor(F.least(F.greatest(F.coalesce(norm, F.lit(-3000.0)), F.lit(-3000.0)), F.lit(3000.0)) + 0.5)
    data = stored(_distinct(usable, k + 1).withColumn("g", norm.cast("int")), "vectors")
    # one row per norm range: at most 6,000, whatever the input
    sizes = {r["g"]: r["count"] for r in data.groupBy("g").count().collect()}
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = 2 * (1 << int(data.select(F.size("v")).first()[0]).bit_length())
    counts = probe_counts(sizes, probe, width ** hashes)
    # ranges probed alike share their tables, numbered on; table -1 is searched whole
    tiers = {c: i for i, c in enumerate(sorted(set(counts.values()) - {0}))}
    deepest = max(tiers, default=0)
    queries = stored(usable.filter(is_query).select(
        "vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit("second"), "v").alias("h2")), "queries")
    sample = data.orderBy("h1", "h2").limit(SAMPLE).drop("g").toArrow()
    shared = spark.sparkContext.broadcast(sample)

    def hashed(batches):
        for batch in batches:
            count = np.array([counts[g] for g in batch.column("g").to_pylist()], np.int64)
            batch = batch.drop_columns(["g"])
            for c in np.unique(count):
                part = batch.filter(pa.array(count == c))
                unit = directions(_matrix(part.column("v")))
                for t in range(tables) if c else [-1]:
                    b = buckets(unit, t, hashes) if c else np.zeros(len(unit), np.int64)
                    at = t + tables * tiers[c] if c else -1
                    yield (part.append_column("t", pa.array(np.full(len(unit), at, np.int32)))
                           .append_column("b", pa.array(b)))

    def probing(batches):
        for batch in batches:
            q = _matrix(batch.column("v"))
            # the (k + 1)-th of the sample, as the query itself may be in it
            near = -np.sort(-(q @ _matrix(shared.value["v"]).T), axis=1)
            low = near[:, k] - 1e-9 * np.abs(near[:, k]) if near.shape[1] > k else np.full(len(q), -np.inf)
            batch = batch.append_column("low", pa.array(low))

            def asking(rows, t, b, p):
                return (rows.append_column("t", pa.array(np.full(rows.num_rows, t, np.int32)))
                        .append_column("b", pa.array(np.ascontiguousarray(b)))
                        .append_column("p", pa.array(np.full(rows.num_rows, p, np.int32))))

            if 0 in counts.values():
                yield asking(batch, -1, np.zeros(len(q), np.int64), 0)
            # tuples of axes are laid out as rows x tuples
            step = max(1, 8_000_000 // (deepest * width)) if hashes > 1 and deepest else max(1, len(q))
            for at in range(0, len(q) if deepest else 0, step):
                rows, unit = batch.slice(at, step), directions(q[at:at + step])
                for t in range(tables):
                    for p, b in enumerate(probes(unit, t, hashes, deepest).T):
                        for c, tier in tiers.items():
                            if p < c:
                                yield asking(rows, t + tables * tier, b, p)

    def from_sample(batches):
        for batch in batches:
            q = pa.Table.from_batches([batch]).append_column("low", pa.array(np.full(batch.num_rows, -np.inf)))
            yield from ranked(None, q, shared.value).to_batches()

    def ranked(key, q: pa.Table, x: pa.Table) -> pa.Table:
        out = {"q1": [], "q2": [], "score": [], "at": []}
        if q.num_rows and x.num_rows:
            qv, xv = _matrix(q["v"]), _matrix(x["v"])
            least = np.array([i[0] for i in x["ids"].to_pylist()])
            q1, q2, low = (q[c].to_numpy() for c in ("h1", "h2", "low"))
            for at in range(0, len(qv), 512):
                s = qv[at:at + 512] @ xv.T
                for i, row in enumerate(s):
                    hit = np.flatnonzero(row >= low[at + i])
                    if len(hit) > k + 1:
                        hit = hit[np.lexsort((least[hit], -row[hit]))[:k + 4]]
                    out["at"].append(hit)
                    out["score"].append(exact_products(qv[at + i], xv[hit]))
                    out["q1"].append(np.full(len(hit), q1[at + i]))
                    out["q2"].append(np.full(len(hit), q2[at + i]))
        cat = {c: np.concatenate(v) if v else np.zeros(0) for c, v in out.items()}
        at = pa.array(cat["at"].astype(np.int64))
        return pa.table({"q1": pa.array(cat["q1"].astype(np.int64)), "q2": pa.array(cat["q2"].astype(np.int64)),
                         "score": pa.array(cat["score"].astype(np.float64)),
                         "h1": x["h1"].take(at), "h2": x["h2"].take(at), "ids": x["ids"].take(at)})

    placed = data.select("h1", "h2", "v", "ids", "g").mapInArrow(
        hashed, "h1 long, h2 long, v array<double>, ids array<bigint>, t int, b long")
    # chunks of the buckets that hold more than one task should rank
    large = (placed.groupBy("t", "b").count().filter(F.col("count") > CHUNK)
             .select("t", "b", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks")))
    large = stored(large, "large-buckets")
    placed = (placed.join(large, ["t", "b"], "left")
              .withColumn("chunk", F.pmod("h2", F.coalesce("chunks", F.lit(1))).cast("int")).drop("chunks"))
    # equal query vectors are searched once
    distinct = queries.dropDuplicates(["h1", "h2"]).select("h1", "h2", "v")
    asked = (distinct
             .mapInArrow(probing, "h1 long, h2 long, v array<double>, low double, t int, b long, p int")
             .join(large, ["t", "b"], "left")
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))).drop("chunks"))

    def search(wanted: DataFrame) -> DataFrame:
        return (wanted.drop("p").groupBy("t", "b", "chunk").cogroup(placed.groupBy("t", "b", "chunk"))
                .applyInArrow(ranked, FOUND))

    # each table's best bucket first: the (k + 1)-th product found there is a floor, and
    # the other buckets need give nothing below it, so what a query finds doesn't grow
    # with the number of vectors
    once = ["q1", "q2", "h1", "h2"]
    sampled = distinct.mapInArrow(from_sample, FOUND)
    near = search(asked.filter("p = 0")).unionByName(sampled).dropDuplicates(once)
    at = F.row_number().over(Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "h1", "h2"))
    floor = near.select("q1", "q2", "score", at.alias("n")).filter(F.col("n") <= k + 1).filter(
        F.col("n") == k + 1).select(F.col("q1").alias("h1"), F.col("q2").alias("h2"), F.col("score").alias("floor"))
    floor = stored(floor, "floors")
    low = F.greatest("low", F.col("floor") - 1e-9 * F.abs("floor"))
    found = search(asked.join(floor, ["h1", "h2"], "left").withColumn("low", low).drop("floor")).unionByName(sampled)
    found = found.dropDuplicates(once).select("q1", "q2", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    # each query without itself; rows sharing a vec_id share the query's answer
    own = queries.select(F.col("vec_id").alias("query_id"), F.col("h1").alias("q1"), F.col("h2").alias("q2"))
    answer = own.join(found, ["q1", "q2"]).filter(F.col("query_id") != F.col("vec_id"))
    return (answer.groupBy("query_id", "q1", "q2").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))), 1, k).alias("near"))
        .select("query_id", F.posexplode("near").alias("at", "x"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"))
