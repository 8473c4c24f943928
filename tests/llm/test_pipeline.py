"""The pipeline, stage by stage, against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict

import brute
import public_tokenizers as P
import tiktoken
from edge import SF_SMALL, edge_docs, no_docs  # noqa: F401  (fixtures)

import corpus_pipeline
from basketlens.llm.bpe_codec import read_ranks
from basketlens.llm.common import stored
from basketlens.llm.mixing import capped_targets


def rows(docs):
    return Counter((r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect())


def stage_outputs(spark, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def check(spark, docs):
    docs, good, lines, single, mixed, tokens = stage_outputs(spark, docs)
    for step in (good, lines, single, mixed):
        assert step.columns == docs.columns

    # rejected: the base rule, severe rules, weak rules on hosts above the limit
    kept = rows(good)
    for (i, t, s), n in rows(docs).items():
        words, chars, symbols, dup, _, failed = brute.quality(t)
        if failed:
            assert (i, t, s) not in kept
        elif symbols <= 0.1 * words and dup < 5 and chars <= 15 * words:
            assert kept[i, t, s] == n
    assert not kept - rows(docs)

    before = list(rows(good).elements())
    want = Counter((i, None if t is None else k[2], s)
                   for (i, t, s), k in zip(before, brute.kept_lines([t for _, t, _ in before])))
    assert rows(lines) == want

    before = list(rows(lines).elements())
    sets = [brute.shingles(t) for _, t, _ in before]
    groups = defaultdict(list)
    for c, row, x in zip(brute.components(sets), before, sets):
        groups[c if x else (c, "empty")].append(row)
    after = rows(single)
    assert sum(after.values()) == len(groups)
    least = Counter(min(i for i, _, _ in g if i is not None) if any(r[0] is not None for r in g) else None
                    for g in groups.values())
    assert Counter(i for i, _, _ in after.elements()) == least

    taken, had = Counter(), Counter()
    for (_, t, s), n in rows(mixed).items():
        taken[s] += n * len(brute.WORD.findall(t or ""))
    for (_, t, s), n in after.items():
        had[s] += n * len(brute.WORD.findall(t or ""))
    assert max(rows(mixed).values(), default=0) <= 2 and not set(rows(mixed)) - set(after)
    order = sorted((s for s in had if had[s]), key=lambda s: (s is None, s or ""))
    everything = sorted(had, key=lambda s: (s is None, s or ""))
    targets = dict(zip(everything, capped_targets([had[s] for s in everything],
                                                  [(5, 2, 1)[i % 3] for i in range(len(everything))], 1.5, 2)))
    biggest = max((len(brute.WORD.findall(t or "")) for _, t, _ in after), default=0)
    for s in order:  # whole documents: within two of the largest
        assert abs(taken[s] - targets[s]) <= 2 * biggest + 0.05 * targets[s]

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                            mergeable_ranks=read_ranks(P.path("byte_bpe_50k.tiktoken")))
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in tokens.collect())
    assert got == Counter((i, len(ids := enc.encode_ordinary(t or "")), brute.sha(" ".join(map(str, ids)).encode()),
                           brute.sha((t or "").encode())) for i, t, _ in rows(mixed).elements())


def test_pipeline_on_documents(spark):
    check(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"))


def test_pipeline_on_edge_cases(spark, edge_docs):  # noqa: F811
    check(spark, edge_docs)


def test_pipeline_without_documents(spark, no_docs):  # noqa: F811
    assert [x.count() for x in stage_outputs(spark, no_docs)] == [0] * 6


def test_run_is_all_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_mixture_meets_targets_with_documents_of_any_length(spark):
    rows = [(1000 * j + i, " ".join(["word"] * (30 if i % 2 else 900)), s)
            for j, (s, n) in enumerate((("a", 500), ("b", 800), ("c", 800))) for i in range(n)]
    had = [sum(len(t.split()) for _, t, x in rows if x == s) for s in "abc"]
    out = corpus_pipeline.mixture(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "")
    taken = Counter()
    for r in out.collect():
        taken[r.source, len(r.text.split())] += len(r.text.split())
    for s, n, t in zip("abc", had, capped_targets(had, [5, 2, 1], 1.5, 2)):
        assert abs(taken[s, 30] + taken[s, 900] - t) <= 0.06 * t
        # long and short documents alike
        assert abs(taken[s, 900] / (n * 30 / 31) - taken[s, 30] / (n / 31)) <= 0.15
