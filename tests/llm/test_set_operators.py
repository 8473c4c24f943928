"""Mixing, near duplicates, resharding, toxicity and nearest neighbours."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from edge import SF_SMALL, edge_docs, no_docs  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from basketlens.llm import near_duplicates as nd
from basketlens.llm import mixing, queries, resharding
from basketlens.llm.components import components
from basketlens.llm.deobfuscation import CharacterModel, restore, suspicious
from basketlens.llm.nearest import hadamard, nearest
from basketlens.llm.shingles import REGISTERS, shingle_sets, similarity, sketch, word_hashes
from basketlens.llm.toxicity import character_counts, score_toxicity


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def expected_groups(rows):
    """Counter of (doc_id, n_shingles, component_id, kept)."""
    sets = [brute.shingles(t) for _, t in rows]
    comp = brute.components(sets)
    least = {}
    for c, (i, _), s in zip(comp, rows, sets):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    out = Counter()
    for c, (i, _), s in zip(comp, rows, sets):
        m = least.get(c) if s else i
        out[i, len(s), m, i == m] += 1
    return out


@pytest.mark.parametrize("blocks", [None, 3])
def test_near_duplicates(edge_docs, spark, monkeypatch, blocks):
    if blocks:  # buckets and clusters cut into pairs of blocks
        monkeypatch.setattr(nd, "BUCKET_BLOCK", 3)
        monkeypatch.setattr(nd, "CLUSTER_BLOCK", 150)
    for docs in (edge_docs, spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs).collect())
        assert got == expected_groups(rows_of(docs))


def test_deduplicated_keeps_one_of_each_group(edge_docs):
    out = nd.deduplicated(edge_docs)
    assert out.columns == edge_docs.columns
    rows = rows_of(edge_docs)
    sets = [brute.shingles(t) for _, t in rows]
    groups = {c for c, s in zip(brute.components(sets), sets) if s}
    kept = rows_of(out)
    assert len(kept) == len(groups) + sum(not s for s in sets)
    assert Counter(i for i, t in kept if i == 28) == {28: 1}


def test_near_copies_at_the_threshold(spark):
    base = [f"t{i}" for i in range(104)]
    rows = []
    for k in range(0, 24):  # k changed words at the end: the shingle sets shrink step by step
        rows.append((k, " ".join(base[:104 - k] + [f"x{k}_{i}" for i in range(k)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs).collect())
    assert got == expected_groups(rows)


def test_word_hashes_match_words():
    text = "Ab cd\tAB  ab\ncd é É".encode()
    h, at = word_hashes(text)
    assert [text[a:].split()[0].lower() for a in at] == text.lower().split()
    assert h[0] == h[2] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 4


def test_long_texts_hash_like_their_parts():
    words = [b"w%d" % (i * 7919 % 5003) for i in range(400_000)]
    (long,) = shingle_sets([b" ".join(words)])
    assert len(long) == len({tuple(words[i:i + 5]) for i in range(len(words) - 4)})


def test_estimates_are_near_the_similarity():
    rng = np.random.RandomState(0)
    for n in (40, 400, 4000):
        a = np.unique(rng.randint(0, 2 ** 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[:int(0.85 * n)], rng.randint(0, 2 ** 62, n - int(0.85 * n)).astype(np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert sketch(a).shape == (REGISTERS,)
        assert abs(similarity(sketch(a), sketch(b)[None], np.array([n]))[0] - true) < 0.25


def test_components_of_a_path_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_targets_are_capped_and_shared_again():
    t = mixing.capped_targets([100, 1000, 10], [5, 2, 1], 1.5, 2)
    assert t[0] == 200 and t[2] == 20 and t[1] == pytest.approx(1665 - 220)


def test_seats_are_the_highest_quotients():
    votes, most = [53.0, 24.0, 23.0, 0.0, 7.5], [100, 100, 100, 5, 2]
    given = [0] * 5
    for house in range(0, 60):
        assert mixing.seats(votes, house, most) == given
        best = max((i for i in range(5) if given[i] < most[i] and votes[i] > 0),
                   key=lambda i: (votes[i] / (2 * given[i] + 1), -i))
        given[best] += 1


def test_mix(edge_docs, spark):
    for docs in (edge_docs, spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        out = mixing.mix(docs).collect()
        want = Counter((r.doc_id, r.source, len(brute.WORD.findall(r.text or ""))) for r in docs.collect())
        assert Counter((r.doc_id, r.source, r["size"]) for r in out) == want
        by = defaultdict(list)
        for r in out:
            by[r.source].append(r)
            assert 0 <= r.taken <= 2 * r["size"] and (r.shard is None) == (r.taken == 0)
        sizes = {s: sum(r["size"] for r in v) for s, v in by.items()}
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        targets = mixing.capped_targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5, 2)
        for s, t in zip(order, targets):
            taken = sum(r.taken for r in by[s])
            assert {r.target for r in by[s]} == {t} and {r.source_size for r in by[s]} == {sizes[s]}
            assert abs(taken - t) <= max(2, 0.05 * sizes[s], 0.04 * t)
        again = Counter(map(tuple, mixing.mix(docs.repartition(7)).collect()))
        assert again == Counter(map(tuple, out))


@pytest.mark.parametrize("seed", range(8))
def test_clusters_of_small_and_large_sets_are_verified_whole(seed):
    """Sets below and above the size from which estimates decide: the links of one
    cluster are those of all pairs."""
    import random

    import pyarrow as pa

    from basketlens.llm import near_duplicates as nd
    rng = random.Random(seed)
    bases = [rng.sample(range(60), rng.choice([1, 3, 4, 8, 30, 31, 32, 40])) for _ in range(50)]
    plain = [frozenset(x) for b in bases for x in (b, b[:-1] or b, [*b, 99])]
    sets = [np.array(sorted(x * 0x9E3779B97F4A7C15 % 2 ** 64 for x in s), np.uint64) for s in plain]
    table = pa.record_batch([pa.array([1] * len(sets)), pa.array([0] * len(sets)), pa.array([0] * len(sets)),
                             pa.array(range(len(sets))), pa.array([s.tobytes() for s in sets])],
                            ["cluster", "i", "j", "node", "shingles"])
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for out in nd._verified_edges(75)(iter([table])):
        for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist()):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert [find(i) for i in range(len(sets))] == brute.components(plain)


def plain_mix(rows, weights=(5, 2, 1), most=2, shards=16, seed=17, width_of=64):
    """Words taken per row of (source, size, place in the seeded order), seat by seat
    and word by word."""
    from fractions import Fraction
    sources = sorted({r[0] for r in rows}, key=lambda x: (x is None, x or ""))
    size = {x: sum(r[1] for r in rows if r[0] == x) for x in sources}
    weight = {x: weights[i % 3] for i, x in enumerate(sources)}
    target, left, open_ = {}, Fraction(3, 2) * sum(size.values()), list(sources)
    while open_:
        unit = left / sum(weight[x] for x in open_)
        over = [x for x in open_ if unit * weight[x] > most * size[x]]
        for x in over or open_:
            target[x] = Fraction(most * size[x]) if over else unit * weight[x]
            left -= target[x]
        open_ = [x for x in open_ if x not in target]
    width = {x: max(1, min(width_of, size[x] // 64)) for x in sources}
    blocks = {x: -(-size[x] // width[x]) for x in sources}
    votes = {x: Fraction(most * blocks[x]) if size[x] and target[x] >= most * size[x] else target[x] / width[x]
             for x in sources}
    seats = dict.fromkeys(sources, 0)
    for _ in range(min(round(float(sum(votes.values()))), sum(most * blocks[x] for x in sources if votes[x]))):
        free = [x for x in sources if votes[x] and seats[x] < most * blocks[x]]
        seats[max(free, key=lambda x: (votes[x] / (2 * seats[x] + 1), -sources.index(x)))] += 1
    taken = [0] * len(rows)
    for x in sources:
        a, b = mixing._permutation(seed, x, blocks[x]) if blocks[x] else (1, 0)
        at = 0
        for i in sorted((i for i, r in enumerate(rows) if r[0] == x), key=lambda i: rows[i][2]):
            for word in range(at, at + rows[i][1]):
                rank = (a * (word // width[x]) + b) % blocks[x]
                taken[i] += seats[x] // blocks[x] + (rank < seats[x] % blocks[x])
            at += rows[i][1]
    return taken, {x: float(target[x]) for x in sources}


@pytest.mark.parametrize("bucket_docs", [4000, 5])
def test_mix_equals_a_seat_by_seat_version(edge_docs, spark, monkeypatch, bucket_docs):
    from basketlens.llm.common import row_key
    monkeypatch.setattr(mixing, "BUCKET_DOCS", bucket_docs)
    small = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    for docs in (edge_docs.filter("doc_id is null or doc_id <> 30"), small):
        r1, r2 = row_key("doc_id", "source", "text")
        keyed = docs.select(r1.alias("r1"), r2.alias("r2"), "source", "text").withColumn(
            "u", F.xxhash64(F.lit(17), "r1", "r2")).collect()
        buckets = max(1, len(keyed) // bucket_docs)
        rows = [(r.source, len(re.findall(r"[^\x20\x09-\x0d]+", r.text or "")), (r.u % buckets, r.u, r.r1, r.r2)) for r in keyed]
        taken, target = plain_mix(rows)
        out = mixing.mix(docs).collect()
        assert Counter((r.r1, r.r2, r.taken) for r in out) == Counter((k.r1, k.r2, t) for k, t in zip(keyed, taken))
        assert all(abs(r.target - target[r.source]) < 1e-6 for r in out)


def test_mixed_documents_follow_the_mix(edge_docs):
    taken = Counter()
    for r in mixing.mix(edge_docs).collect():
        if r["size"]:
            taken[r.doc_id, r["size"]] += int(r.taken / r["size"] + 0.5)
    out = mixing.mixed_documents(edge_docs)
    assert out.columns == edge_docs.columns
    got = Counter((i, len(brute.WORD.findall(t or ""))) for i, t in rows_of(out))
    assert got == +taken


def test_flow_moves_the_fewest_bytes():
    blocks = [resharding.Block(0, 1, 6, 60), resharding.Block(0, 2, 4, 400), resharding.Block(1, 1, 3, 300)]
    transfers = resharding.plan_transfers(blocks, 3)
    moved = Counter()
    for t in transfers:
        moved[t.shard, t.size_class] += t.high - t.low
    # 13 rows to 5 + 4 + 4: shard 0 gives 5 small rows, 1 of them to shard 1
    assert moved == {(0, 1): 5}
    assert Counter(t.to for t in transfers for _ in range(t.low, t.high)) in ({1: 1, 2: 4}, {1: 2, 2: 4}, {1: 1, 2: 4})


def test_reshard(edge_docs, spark, monkeypatch):
    monkeypatch.setattr(resharding, "PART_ROWS", 1)
    monkeypatch.setattr(resharding, "PART_BYTES", 4000)
    for docs in (edge_docs, spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        for old, new in ((12, 16), (5, 3), (4, 4)):
            layout = resharding.reshard_documents(docs, old, new)
            out = resharding.shard_slots(layout).collect()
            assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(
                (i, len((t or "").encode()) + 1, brute.crc(t)) for i, t in rows_of(docs))
            slots = defaultdict(list)
            for r in out:
                slots[r.shard].append(r.slot)
            counts = [len(slots.get(j, [])) for j in range(new)]
            assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(new))
            assert all(sorted(v) == list(range(len(v))) for v in slots.values())
            assert Counter(rows_of(layout)) == Counter(rows_of(docs))


def test_restoring_words(spark):
    docs = spark.createDataFrame([("the stupid idiot and the loser came to the pathetic house " * 20,)], "text string")
    model = CharacterModel(character_counts(docs))
    for written, want in (("1d10t", "idiot"), ("stuuuupid", "stupid"), ("$tup1d", "stupid"), ("l0s3r", "loser"),
                          ("i.d.i.o.t", "idiot"), ("p@th3t1c", "pathetic")):
        assert suspicious(written) and restore(written, model) == [want]
    assert restore("idiot", model, spaced=True) == ["idiot"]
    assert not suspicious("house") and not suspicious("1234") and not suspicious("")


def best_path(word, model, spaced):
    """Score of the best of all ways to read ``word``, one by one."""
    from basketlens.llm import deobfuscation as d
    short = d._RUN.sub(r"\1\1", word)
    best = -1e18

    def walk(i, a, b, letters, score):
        nonlocal best
        if i == len(short):
            best = max(best, score + model.table[a][b][0])
            return
        c, plain = short[i], short[i].isalpha()
        ways = 0
        for x, p in [(c, d.PLAIN)] if plain else [(x, d.SWAPPED - np.log(len(d.LOOKALIKES[c]))) for x in d.LOOKALIKES.get(c, "")]:
            k = d.letter_class(x)
            walk(i + 1, b, k, letters + x, score + p + model.table[a][b][k])
            ways += 1
            if spaced and b:
                walk(i + 1, 0, k, letters + x, score + p + d.BREAK + model.table[a][b][0] + model.table[b][0][k])
            if letters and letters[-1] == x and i and c == short[i - 1]:
                walk(i + 1, a, b, letters, score + d.STRETCH)
        if not plain:
            walk(i + 1, a, b, letters, score + (d.DIGIT if c.isdigit() else d.SIGN))

    walk(0, 0, 0, "", 0.0)
    return best


def test_viterbi_finds_the_best_of_all_paths(spark):
    from basketlens.llm.deobfuscation import decode
    docs = spark.createDataFrame([("the stupid idiot and the loser came to the pathetic house " * 20,)], "text string")
    model = CharacterModel(character_counts(docs))
    rng = np.random.RandomState(2)
    for _ in range(400):
        word = "".join(rng.choice(list("idotsel1!3$*.-")) for _ in range(rng.randint(1, 8)))
        for spaced in (False, True):
            assert abs(decode(word, model, spaced)[0] - best_path(word, model, spaced)) < 1e-9, word


def test_long_words_are_decoded_like_short_ones(spark):
    """No length from which another rule holds, and time in proportion to it."""
    import time
    docs = spark.createDataFrame([("the stupid idiot and the loser came to the pathetic house " * 20,)], "text string")
    model = CharacterModel(character_counts(docs))
    assert restore("st0pid1d10t" * 30, model) == ["".join(restore("st0pid1d10t" * 30, model))]
    start = time.process_time()
    restore("1d10t$tup1d" * 4000, model)
    assert time.process_time() - start < 30
    from basketlens.llm.toxicity import Scorer
    scorer = Scorer(model, {"patheticloserx": 3.0})
    assert scorer.features("pa th et ic lo se rx")[0] == 3                # seven pieces


def toxic_rows():
    rng = np.random.RandomState(5)
    words = [f"{a}{b}" for a in ("mor", "tal", "rin", "sep", "lun") for b in ("a", "os", "ent", "ing", "ul")]
    rows, labels = [], []
    for i in range(600):
        w = list(rng.choice(words, 60))
        toxic = i % 5 == 0 or i % 7 == 0
        if toxic:
            for p in rng.choice(60, 4):
                w[p] = rng.choice(["idiot", "scum", "1d10t", "$cum", "i d i o t"]) if i % 2 else rng.choice(["idiot", "scum"])
        rows.append((i, " ".join(w), "s"))
        labels.append((i, 0, int(toxic)))
    return rows, labels


def test_toxicity(spark, edge_docs):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = score_toxicity(docs, marks).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _, _ in rows if brute.crc(str(i)) % 5 == 0}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    # null, empty, long, repeated rows; labels of one kind only; no rows
    edge = score_toxicity(edge_docs, marks.filter("toxic = 0")).collect()
    assert len(edge) == edge_docs.count() and len({r.score for r in edge}) == 1
    assert score_toxicity(docs.filter("false"), marks).count() == 0


def test_toxic_words_between_signs_in_pieces_and_long(spark):
    from basketlens.llm.toxicity import Scorer
    docs = spark.createDataFrame([("the stupid idiot and the loser came to the pathetic house " * 20,)], "text string")
    scorer = Scorer(CharacterModel(character_counts(docs)), {"idiot": 3.0, "stupid": 2.0, "pathetic": 1.0})
    for text, want in (("bla.idiot", 3), ("you/idiot", 3), ("you-idiot now", 3), ("well...idiot", 3), ("you!idiot", 3),
                       ("bla.1d10t", 3), ("id iot.", 3), ("st u pid", 2), ("-.~^_".join("pathetic"), 1),
                       ("x" + "ab-" * 100 + "idiot", 3), ("the house came", 0)):
        assert scorer.features(text)[0] == want, text


def vectors(spark):
    rng = np.random.RandomState(9)
    x = rng.normal(size=(300, 12)).astype(np.float32)
    x[50:90] = x[50]  # a large group of equal vectors
    rows = [(i, [float(v) for v in r], "clash") for i, r in enumerate(x)]
    rows += [(1000, None, ""), (1001, [0.0] * 12, ""), (1002, [float("nan")] * 12, ""), (1003, [1.0] * 5, ""),
             (1004, [None] + [1.0] * 11, ""), (1005, [float("inf")] * 12, ""), (None, [1.0] * 12, ""), (1006, [], "")]
    return x.astype(float), spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


def test_nearest_with_all_buckets_is_exact(spark, monkeypatch):
    from basketlens.llm import nearest as nn
    monkeypatch.setattr(nn, "SAMPLE", 40)
    monkeypatch.setattr(nn, "CHUNK", 16)
    x, table = vectors(spark)
    got = defaultdict(list)
    for r in nearest(table, F.col("vec_id") % 20 == 0, k=20, tables=1, probe=32).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 300, 20))
    for q, rows in got.items():
        s = (x[q] * x).sum(axis=1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(300), -s))[:20]
        assert [(n, v) for n, v, _ in sorted(rows)] == [(n + 1, v) for n, v in enumerate(want)]
        assert max(abs(p - s[v]) for _, v, p in rows) < 1e-12


def test_nearest_of_few_and_no_vectors(spark):
    x, table = vectors(spark)
    few = nearest(table.filter("vec_id < 5"), F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert nearest(table.filter("vec_id > 1000"), F.lit(True)).count() == 0


def test_two_hashes_per_table_find_close_vectors(spark):
    rng = np.random.RandomState(1)
    centres = rng.normal(size=(30, 16))
    x = centres.repeat(30, axis=0) + 0.05 * rng.normal(size=(900, 16))
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    out = nearest(table, F.col("vec_id") % 50 == 0, k=5, tables=6, probe=24, hashes=2).collect()
    hits = sum(r.vec_id in np.lexsort((np.arange(900), -(np.where(np.arange(900) == r.query_id, -np.inf, x @ x[r.query_id]))))[:5]
               for r in out)
    assert hits / len(out) >= 0.9


@pytest.mark.parametrize("norms", ["one", "uneven"])
def test_nearest_of_uneven_norms(spark, monkeypatch, norms):
    from basketlens.llm import nearest as nn
    monkeypatch.setattr(nn, "SAMPLE", 30)
    monkeypatch.setattr(nn, "CHUNK", 64)
    rng = np.random.RandomState(3)
    x = rng.normal(size=(3000, 64))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    if norms == "one":
        x[7] *= 10
    else:
        x *= np.exp(rng.normal(0, 0.5, len(x)))[:, None]
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = nearest(table, F.col("vec_id") % 60 == 0, k=20).groupBy("query_id").agg(F.collect_set("vec_id").alias("v"))
    hits = 0
    for r in got.collect():
        s = x @ x[r.query_id]
        s[r.query_id] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & set(r.v))
    print("recall", norms, hits / 1000)
    assert hits / 1000 >= 0.93


def test_probes_by_norm_stay_within_twice_the_work():
    from basketlens.llm.nearest import probe_counts
    assert probe_counts({0: 20_000}, 20, 256) == {0: 20}
    assert probe_counts({0: 20_000, 7: 1}, 20, 256) == {0: 20, 7: 0}
    assert probe_counts({0: 60_000, 20: 40_000}, 20, 256) == {0: 20, 20: 20}


def test_hadamard_is_orthogonal():
    h = hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and set(np.round(np.abs(h).ravel(), 6)) == {0.25}


def test_empty_tables(no_docs):
    assert nd.near_duplicates(no_docs).count() == 0
    assert nd.deduplicated(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0
    assert resharding.shard_slots(resharding.reshard_documents(no_docs)).count() == 0


def test_set_queries_give_a_row_per_document(spark):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for name in ("op1_mix_sources", "op2_near_duplicates", "op3_reshard", "op4_toxicity"):
        out = queries.QUERIES[name](spark, SF_SMALL)
        assert out.select(F.countDistinct("doc_id"), F.count(F.lit(1))).first() == (n, n), name
