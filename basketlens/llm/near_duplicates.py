"""Near-duplicate groups by HyperMinHash (operator 2).

1. Every document gets its distinct five-word shingles, a digest of the set and
   a HyperMinHash sketch. Documents with equal sets form a class at once.
2. Classes that share a band of registers meet in a bucket. Inside a bucket,
   classes whose collision-corrected estimate is at least LIKELY are joined by
   a spanning forest, never by all pairs; forests make up loose clusters.
3. Only classes in clusters of two or more get their full sets again. Inside a
   cluster, estimates pick the pairs to verify and full sets decide; a class
   already reached is not compared with its own component again.

A bucket or cluster too large for one task is cut into blocks, and each pair of
blocks is a task: no pair is left out, and each task emits a forest only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import give_back, lookup_join, row_key, stored
from basketlens.llm.components import components
from basketlens.llm.shingles import BANDS, REGISTERS, band_keys, digest, shingle_sets, similarity, sketch

# Estimates have a standard error of 0.04 to 0.05 at similarity 0.75: pairs
# below this estimate are no candidates. Sets below SMALL shingles borrow most of
# their registers and may err more: they are compared whole, whatever the estimate.
LIKELY = 0.5
SMALL = 32
# classes of a bucket, shingles of a cluster, that one block holds
BUCKET_BLOCK = 4_000
CLUSTER_BLOCK = 1_000_000


def _texts(column: pa.Array, limit: int = 1 << 20):
    """Lists of the texts (bytes) of a binary column, about ``limit`` bytes each."""
    texts, size = [], 0
    for at in range(0, len(column), 64):
        for t in column.slice(at, 64).to_pylist():
            texts.append(t or b"")
            size += len(texts[-1])
            if size >= limit:
                yield texts
                texts, size = [], 0
    if texts:
        yield texts


def _sketch_rows(batches):
    for batch in batches:
        n, sets, sketches = [], [], []
        for texts in _texts(batch.column("text")):
            for s in shingle_sets(texts):
                n.append(len(s))
                sets.append(digest(s) if len(s) else None)
                sketches.append(sketch(s).tobytes() if len(s) else None)
        yield (batch.drop_columns(["text"]).append_column("n_shingles", pa.array(n, pa.int64()))
               .append_column("cid", pa.array(sets, pa.binary())).append_column("sketch", pa.array(sketches, pa.binary())))


def _band_rows(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = band_keys(_sketches(batch.column("sketch")))
        for band in range(BANDS):
            yield pa.record_batch([pa.array(np.ascontiguousarray(keys[:, band])), batch.column("node")], ["key", "node"])


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _runs(batches, keys: list[str]):
    """Tables of the rows with equal ``keys`` from batches sorted by them; at most
    one run and one batch are held."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in cols)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _forest(n: int, linked, start: np.ndarray):
    """(pivot, members) of a breadth-first search: ``linked(pivot, rest)`` tells
    which of ``rest`` link to the pivot; reached nodes leave ``rest``. Pivots are
    tried in the order ``start``, so a likely hub first."""
    rest = np.ones(n, bool)
    for root in start:
        if not rest[root]:
            continue
        rest[root] = False
        queue = [int(root)]
        while queue:
            pivot = queue.pop()
            left = np.flatnonzero(rest)
            if not len(left):
                return
            found = left[linked(pivot, left)]
            if len(found):
                rest[found] = False
                queue += found.tolist()
                yield pivot, found


def _hubs_first(sketches: np.ndarray) -> np.ndarray:
    """Rows by falling agreement with the registers' commonest values."""
    if len(sketches) < 3:
        return np.arange(len(sketches))
    order = np.sort(sketches, axis=0)
    middle = order[len(order) // 2]
    return np.argsort(-(sketches == middle).sum(axis=1), kind="stable")


def _stars(nodes: np.ndarray, forest) -> tuple[list, list]:
    """(a, b): every reached node and the smallest node of its tree."""
    root = np.arange(len(nodes))
    for pivot, found in forest:
        root[found] = root[pivot]
    least = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(least, root, nodes)
    linked = np.flatnonzero(nodes != least[root])
    return nodes[linked].tolist(), least[root[linked]].tolist()


def _edges(a: list, b: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _bucket_edges(batches):
    """(a, b): a star for each tree of a bucket's likely pairs."""
    a, b = [], []
    for run in _runs(batches, ["key", "i", "j"]):
        sketches, size = _sketches(run["sketch"]), run["n_shingles"].to_numpy()

        def likely(p, rest):
            large = np.maximum(size[p], size[rest])
            return (large < SMALL) | (similarity(sketches[p], sketches[rest], large) >= LIKELY)

        x, y = _stars(run["node"].to_numpy(), _forest(len(size), likely, _hubs_first(sketches)))
        a += x
        b += y
        if len(a) > 5000:
            yield _edges(a, b)
            a, b = [], []
    yield _edges(a, b)
    give_back()


def _verified_edges(percent: int):
    """mapInArrow over classes sorted by cluster and pair of blocks: a star for
    each tree of pairs whose full sets are similar enough."""
    def run(batches):
        for table in _runs(batches, ["cluster", "i", "j"]):
            sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
            sizes = np.array([len(s) for s in sets])
            sketches = np.stack([sketch(s) for s in sets])
            _, codes = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            marks = np.zeros(int(codes.max()) + 2, bool)
            # small sets side by side, filled up with a code that nobody has
            place = np.flatnonzero(sizes < SMALL)
            row_of = np.zeros(len(sizes), np.int64)
            row_of[place] = np.arange(len(place))
            short = np.full((len(place), SMALL), len(marks) - 1, np.int32)
            short[np.arange(SMALL) < sizes[place][:, None]] = codes[np.repeat(sizes < SMALL, sizes)]

            def linked(p, rest):
                small, large = np.minimum(sizes[p], sizes[rest]), np.maximum(sizes[p], sizes[rest])
                ok = 100 * small >= percent * large
                tiny = np.flatnonzero(ok & (large < SMALL))
                ok[tiny] = False
                ok[ok] = similarity(sketches[p], sketches[rest[ok]], large[ok]) >= LIKELY
                mine = codes[starts[p]:starts[p + 1]]
                marks[mine] = True
                both = marks[short[row_of[rest[tiny]]]].sum(axis=1)
                found = 100 * both >= percent * (sizes[p] + sizes[rest[tiny]] - both)
                for k in np.flatnonzero(ok):
                    both = int(marks[codes[starts[rest[k]]:starts[rest[k] + 1]]].sum())
                    ok[k] = 100 * both >= percent * (sizes[p] + sizes[rest[k]] - both)
                marks[mine] = False
                ok[tiny] = found
                return ok

            yield _edges(*_stars(table["node"].to_numpy(), _forest(len(sizes), linked, _hubs_first(sketches))))
        give_back()
    return run


def _block_pairs(rows: DataFrame, blocks: Column) -> DataFrame:
    """Each row once per pair (i, j), i <= j, of blocks that holds its own block;
    one block: (0, 0) only."""
    rows = rows.withColumn("blocks", blocks).withColumn(
        "mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "*", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")).drop("blocks", "mine", "other")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """r1, r2 (row key), doc_id, n_shingles, component_id, root, kept per row of
    ``docs`` (doc_id, text).

    Documents are linked when their shingle sets' intersection is at least
    ``percent`` % of the union; component_id is the smallest doc_id reachable,
    root names the group. Null and empty texts, and texts without words, are
    linked with nothing (root null). Repeated rows are documents of their own in
    one group; null doc_ids count as larger than any other (a group of nulls only
    has component_id null, kept true). An empty table gives no rows.
    """
    r1, r2 = row_key("doc_id", "text")
    source = docs.select(r1.alias("r1"), r2.alias("r2"), F.col("doc_id").cast("long"),
                         F.col("text").cast("binary").alias("text"))
    keyed = "r1 long, r2 long, doc_id long, n_shingles long, cid binary, sketch binary"
    rows = stored(source.mapInArrow(_sketch_rows, keyed), "sketches")
    classes = rows.filter("cid is not null").groupBy("cid").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first(F.struct("r1", "r2")).alias("row"),
        F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    # stored once, so a class keeps its number
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    bands = classes.select("node", "sketch").mapInArrow(_band_rows, "key long, node long")
    shared = stored(bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    members = bands.join(shared, "key").join(classes.select("node", "sketch", "n_shingles"), "node")
    edges = (_block_pairs(members, F.ceil(F.col("n") / BUCKET_BLOCK).cast("int"))
             .select("key", "i", "j", "node", "sketch", "n_shingles")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
             .mapInArrow(_bucket_edges, "a long, b long"))
    clusters = stored(components(edges), "clusters")

    # the full sets of the classes in clusters, from one row of each class
    sized = clusters.join(classes.select("node", "row", "n_shingles"), "node")
    weight = stored(sized.groupBy("root").agg(
        F.ceil(F.sum("n_shingles") / CLUSTER_BLOCK).cast("int").alias("blocks")), "cluster-sizes")
    wanted = sized.join(weight, "root").select("row.r1", "row.r2", "node", F.col("root").alias("cluster"), "blocks")

    def with_sets(batches):
        for batch in batches:
            sets = [x.tobytes() for texts in _texts(batch.column("text")) for x in shingle_sets(texts)]
            yield batch.drop_columns(["text"]).append_column("shingles", pa.array(sets, pa.binary()))

    # the same shuffle join at every size; Spark splits it where a row repeats often
    texts = source.select("r1", "r2", "text").join(stored(wanted, "wanted").hint("merge"), ["r1", "r2"])
    full = (texts.select("node", "cluster", "blocks", "text").dropDuplicates(["node"])
            .mapInArrow(with_sets, "node long, cluster long, blocks int, shingles binary"))
    verified = stored(_block_pairs(full, F.col("blocks"))
                      .select("cluster", "i", "j", "node", "shingles")
                      .repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
                      .mapInArrow(_verified_edges(percent), "a long, b long"), "verified")

    # stars of clusters in one block are whole; others meet in their common nodes
    groups = (verified.select(F.col("a").alias("node"), F.col("b").alias("root"))
              if weight.filter("blocks > 1").isEmpty() else stored(components(verified), "groups"))
    grouped = classes.select("cid", "node", "least", "n").join(groups, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    first = stored(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "group-ids")
    answer = stored(grouped.join(first, "root").select("cid", "n", "root", "component_id"), "answer")
    linked = lookup_join(rows.filter("cid is not null").drop("sketch"), answer, ["cid"], "n")
    alone = (rows.filter("cid is null").drop("sketch").withColumn("n", F.lit(1).cast("long"))
             .withColumn("root", F.lit(None).cast("long")).withColumn("component_id", F.col("doc_id")))
    return linked.unionByName(alone).select(
        "r1", "r2", "doc_id", "n_shingles", "component_id", "root",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` less near duplicates, all columns: of each group one
    row stays, that of the smallest doc_id (null last; of repeated rows one).
    Rows without words all stay."""
    found = near_duplicates(docs, percent)
    one = found.filter("root is not null").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1", "r2")).alias("k"))
    empty = found.filter("root is null").select("r1", "r2").distinct().withColumn("single", F.lit(False))
    keep = one.select("k.r1", "k.r2").withColumn("single", F.lit(True)).unionByName(empty)
    keep = keep.select(F.col("r1").alias("__r1"), F.col("r2").alias("__r2"), F.col("single").alias("__single"))
    r1, r2 = row_key("doc_id", "text")
    rows = docs.withColumn("__r1", r1).withColumn("__r2", r2).join(keep, ["__r1", "__r2"])
    kept = rows.filter("__single").dropDuplicates(["__r1", "__r2"]).unionByName(rows.filter("not __single"))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
