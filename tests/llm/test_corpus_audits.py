"""Quality classifier (op11), spelling variants (op12) and source divergence (op13)
against plain Python, held-out labels and edge cases."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from edge import SF_SMALL, edge_docs, no_docs  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from basketlens.llm import divergence, spelling, subword_classifier
from basketlens.llm.divergence import source_divergence
from basketlens.llm.spelling import search_shard, spelling_variants
from basketlens.llm.subword_classifier import BUCKETS, Features, score_quality

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- spelling variants -------------------------------------------------------
def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows, shortest=6, least=5, ratio=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= least}
    out = {}
    for w, n in words.items():
        near = [x for x in words if abs(len(x) - len(w)) < 2 and x != w and one_apart(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = (n, len(near), form, words.get(form))
    result = {}
    for w, (n, k, form, form_n) in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        result[w] = (n, k, form, form_n, root)
    return result


def variants(docs, **options):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling_variants(docs, **options).collect()}


def doc_rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_variants_of_the_edge_cases(edge_docs):
    got = variants(edge_docs, shortest=3, least=2, ratio=2)
    assert got == brute_variants(doc_rows(edge_docs), 3, 2, 2) and len(got) > 50


def test_variants_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert variants(docs) == brute_variants(doc_rows(docs))


def test_forms_lead_on_to_a_root(spark):
    chain = [("harbour", 500), ("harbor", 90), ("harbon", 16), ("harbxn", 3), ("hérbour", 5), ("HARBOURS", 20)]
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(chain)] + [(100, None), (101, ""), (None, "harbour")]
    got = variants(spark.createDataFrame(rows, "doc_id long, text string"), least=3)
    want = brute_variants(rows, 6, 3, 5)
    assert got == want
    assert {got[w][4] for w in ("harbour", "harbor", "harbon", "harbxn") if w in got} == {"harbour"}


def test_damage_rule_and_hot_words(spark):
    """A third of all words are one word: it is damaged in one document of 199."""
    rows = [(i, "committee meeting harbour " * 3 + f"commitee{'x' * (i % 3)}") for i in range(900)]
    got = variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute_variants(rows)


@pytest.mark.parametrize("seed", range(40))
def test_search_schemes_find_each_near_pair_once(seed):
    rng = random.Random(seed)
    letters = ["a", "ab", "abé", "abcdefgh"][seed % 4]
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(rng.choice([1, 2, 60, 150]))})
    blocks = 1 + seed % 3
    got = []
    for side in (0, 1):
        for block in range(blocks):
            mine = [w for w in words if zlib.crc32(w.encode("latin-1")) % blocks == block or rng.random() < 0.3]
            rows = [(w, 1, None, 1) for w in mine] + [(w, 1, block, blocks) for w in words]
            table = pa.table({"word": [r[0] for r in rows], "n": [r[1] for r in rows],
                              "block": pa.array([r[2] for r in rows], pa.int32()), "blocks": [r[3] for r in rows]})
            for found in search_shard(side, table):
                got += zip(found["word"].to_pylist(), found["near"].to_pylist())
    assert sorted(got) == sorted((a, b) for a in words for b in words if a != b and one_apart(a, b))


def test_hot_halves_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 10)
    monkeypatch.setattr(spelling, "SHARD_ROWS", 50)
    rng = random.Random(1)
    words = sorted({"prefix" + "".join(rng.choice("abc") for _ in range(rng.randint(4, 6))) for _ in range(200)})
    rows = [(i, " ".join([w] * rng.choice([5, 6, 60]))) for i, w in enumerate(words)]
    got = variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute_variants(rows)


def test_very_long_and_periodic_words(spark):
    rows = [(i, " ".join(["a" * n] * 5)) for i, n in enumerate((6, 7, 8, 3000, 3001, 3003))]
    got = variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute_variants(rows)


# --- source divergence -------------------------------------------------------
def brute_divergence(rows, least=10, ranks=10):
    n, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups[lang].add(source)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
        n[lang, source].update(found)
        df[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = {t for t, c in df[lang].items() if c >= least}
        v = len(kept)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // (total + 2 * v) for t in kept}

        p = {s: shares(n[lang, s]) for s in sources}
        q = shares(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum((a - b) ** 2 // (a + b) for a, b in ((p[s][t], p[o][t]) for t in kept)), o)
                     for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            key = (lambda x: (x[0], x[1].encode()))
            out |= {(lang, s, "pair", o, -x, i) for i, (x, o) in enumerate(sorted(pairs, key=key), 1)}
            out |= {(lang, s, "term", t, -x, i) for i, (x, t) in enumerate(sorted(terms, key=key)[:ranks], 1)}
    return out


def divergences(docs, **options):
    rows = source_divergence(docs, **options).collect()
    out = {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in rows}
    assert len(out) == len(rows)
    return out


def lang_rows(docs):
    return [(r.text, r.lang, r.source) for r in docs.select("text", "lang", "source").collect()]


@pytest.mark.parametrize("blocks", [(8, 10_000), (2, 7)])
def test_divergence_of_the_table(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "SOURCES", blocks[0])
    monkeypatch.setattr(divergence, "TERMS", blocks[1])
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert divergences(docs) == brute_divergence(lang_rows(docs))


def test_divergence_of_the_edge_cases(edge_docs):
    lang = F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 2 == 0, "en").otherwise("de")
    docs = edge_docs.drop("n").withColumn("lang", lang)
    got = divergences(docs, least=2, ranks=3)
    assert got == brute_divergence(lang_rows(docs), 2, 3) and got


def test_divergence_ties_empty_groups_and_single_sources(spark):
    rows = [("one two", "en", "b")] * 12 + [("one two", "en", "a")] * 12 + [(None, "en", "empty"), ("", "xx", "only"),
                                                                            ("rare", "yy", "s"), ("rare", "yy", "t")]
    got = divergences(spark.createDataFrame(rows, "text string, lang string, source string"))
    assert got == brute_divergence(rows)
    assert ("en", "a", "pair", "b", 0, 2) in got or ("en", "a", "pair", "b", 0, 1) in got
    assert ("yy", "s", "pair", "t", 0, 1) in got              # no kept terms: the pair is still there
    assert not [x for x in got if x[0] == "xx"]


def test_divergence_shares_are_exact_beyond_64_bits(spark):
    big = 3 * 10 ** 12                                        # 10**9 times this is beyond 64 bits
    df = spark.createDataFrame([(big, 7 * 10 ** 12, 1000)], "n long, total long, kept long")
    assert df.select(divergence._share("n", "total", "kept")).first()[0] == 1 + 10 ** 9 * (big + 2) // (7 * 10 ** 12 + 2000)


# --- quality classifier ------------------------------------------------------
def auc(score, label):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    p = label == 1
    return (ranks[p].sum() - p.sum() * (p.sum() + 1) / 2) / (p.sum() * (~p).sum())


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = score_quality(docs, labels).join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").toPandas()
    assert len(out) > 50 and out["score"].between(0, 1).all()
    assert (out["predicted"] == (out["score"] >= 0.3)).all()
    assert auc(out["score"].to_numpy(), out["quality"].to_numpy()) > 0.97
    assert (out["predicted"] == out["quality"]).mean() > 0.95


def test_quality_scores_use_the_text_only_and_agree_with_one_by_one(spark, edge_docs):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)] + [(1, 0, 0), (2, 7, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = score_quality(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    text = defaultdict(set)
    by_id = defaultdict(set)
    for r in edge_docs.select("doc_id", "text").collect():
        by_id[r.doc_id].add(r.text)
    for r in rows:
        if len(by_id[r.doc_id]) == 1:
            text[next(iter(by_id[r.doc_id])) or ""].add(r.score)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert all(len(s) == 1 for s in text.values())
    assert text[""] == text[" \t\n\x0b "]                     # no features: the base rate


def plain_features(text):
    """Strings behind the table rows, one by one."""
    words = text.split()
    grams = Counter()
    for w in words:
        padded = f" {w} "
        for n in subword_classifier.NGRAMS:
            for i in range(len(padded) - n + 1):
                grams[padded[i:i + n]] += 1
    pairs = Counter("same" if a == b else (a, b) for a, b in zip(words, words[1:]))
    return grams, Counter(words), pairs


@pytest.mark.parametrize("piece", [1 << 20, 64])
def test_features_count_what_they_should(monkeypatch, piece):
    """As many table rows as features, equal features in equal rows, whatever the piece size."""
    monkeypatch.setattr(subword_classifier, "PIECE", piece)
    rng = random.Random(piece)
    texts = [" ".join(rng.choice(["the", "of", "harbour!!", "The", "x", "###", "a" * 90]) for _ in range(rng.randint(0, 60)))
             for _ in range(30)] + ["", "   ", "one", "a a a a", "z" * 500]
    features = Features()
    counts = np.zeros((len(texts), 3 * BUCKETS), np.int64)
    for of, rows in features.rows([t.encode() for t in texts]):
        np.add.at(counts, (of, rows), 1)
    known = {}
    for i, t in enumerate(texts):
        for kind, want in enumerate(plain_features(t)):
            got = counts[i, kind * BUCKETS:(kind + 1) * BUCKETS]
            assert got.sum() == sum(want.values()), (kind, t[:40])
            assert sorted(got[got > 0]) == sorted(want.values()) or len(got[got > 0]) < len(want)
            known.setdefault(kind, set()).update(np.flatnonzero(got))
    used, n = Features().counted(texts[3].encode())
    assert dict(zip(used, n)) == {i: c for i, c in enumerate(counts[3]) if c}


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score_quality(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert len({r.score for r in score_quality(docs, ones).collect()}) == 1


def test_empty_tables(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert score_quality(no_docs, labels).count() == 0
    assert spelling_variants(no_docs).count() == 0
    assert source_divergence(no_docs).count() == 0
