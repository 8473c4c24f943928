"""Row-wise and line operators against plain Python on edge cases and sf0.001."""

from __future__ import annotations

import base64
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers as P
import pytest
from edge import SF_SMALL, edge_docs, no_docs  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from basketlens.llm import bpe_codec, queries, token_files
from basketlens.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines
from basketlens.llm.merging import merge
from basketlens.llm.quality_rules import quality_verdicts
from basketlens.llm.token_counts import count_tokens


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(params=["edge", "sf"])
def docs(request, spark, edge_docs):
    return edge_docs if request.param == "edge" else small(spark)


def test_quality_counts(docs):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = quality_verdicts(docs).collect()
    assert Counter((r.doc_id, *(r[c] for c in cols)) for r in out) == Counter(
        (i, *brute.quality(t)) for i, t in pairs(docs))
    assert all(not r.kept for r in out if r.base_failed)


def test_quality_windows_beyond_the_packed_positions(spark, monkeypatch):
    from basketlens.llm import quality_rules
    monkeypatch.setattr(quality_rules, "POSITION_BITS", 3)
    monkeypatch.setattr(quality_rules, "POSITIONS", 7)
    text = " ".join(str(i % 11) for i in range(60)) + " a b c a b d"
    d = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    assert quality_verdicts(d).first().n_repeat_words == brute.quality(text)[4]


def test_a_weak_failure_goes_on_a_bad_host_only(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    table = clean + " " + " | ".join(f"cell{i}" for i in range(40))
    rows = [(i, clean, f"host{i % 8}") for i in range(200)]
    rows += [(1000 + i, table, "bad") for i in range(20)] + [(2000, table, "host1"), (2001, clean, "bad"), (2002, table, None)]
    out = {r.doc_id: r for r in quality_verdicts(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not out[1000].kept and out[2000].kept and out[2001].kept
    assert out[1000].by_host and out[2000].by_host and not out[2001].by_host
    assert sum(r.by_host for r in out.values()) == 22


def test_hosts_that_agree_are_not_bad(spark):
    table = " | ".join(f"cell{i}" for i in range(60))
    rows = [(i, table, f"host{i % 4}") for i in range(40)]
    out = quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(r.kept and r.by_host for r in out)


def test_quality_keeps_clean_documents_of_bad_hosts(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    rows = [(i, "junk $$$ ### " * 40, "bad") for i in range(30)] + [(100, clean, "bad"), (101, clean, "good")]
    out = {r.doc_id: r for r in quality_verdicts(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[100].kept and out[101].kept and not out[0].kept
    assert out[100].host_rate > out[101].host_rate


def test_line_dedup(docs):
    rows = pairs(docs)
    want = Counter((i, *k) for (i, _), k in zip(rows, brute.kept_lines([t for _, t in rows])))
    out = dedup_lines(docs, 10)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()) == want
    assert set(docs.columns) | {"kept_text", "n_lines", "n_dropped"} == set(out.columns)


def test_line_index_is_reversible(spark):
    docs = small(spark).select("doc_id", "text")
    first, second = docs.filter("doc_id % 3 > 0"), docs.filter("doc_id % 3 = 0")
    index = LineIndex(spark, threshold=3).insert(first)
    both = index.insert(second)
    back = both.delete(second)

    def state(x):
        return sorted(map(tuple, x.refs.select("h1", "h2", "n").collect()))

    assert state(back) == state(index) != state(both)
    rows = pairs(docs)
    want = brute.kept_lines([t for _, t in rows], 3)
    got = {r.doc_id: r.kept_text for r in both.apply(docs).collect()}
    assert got == {i: k[2] for (i, _), k in zip(rows, want)}
    again = {r.doc_id: r.kept_text for r in back.apply(first).collect()}
    assert again == {r.doc_id: r.kept_text for r in index.apply(first).collect()}
    with pytest.raises(ValueError):
        index.delete(docs)


def test_hot_lines_meet_copies_of_their_filter(spark, monkeypatch):
    from basketlens.llm import line_dedup
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 20)
    monkeypatch.setattr(line_dedup, "MIN_SHARDS", 2)
    rows = [(i, f"hot\nline {i % 7}\nown {i}\nHOT ") for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = dedup_lines(docs, 10).collect()
    assert {r.kept_text for r in out} == {f"own {i}" for i in range(70)}
    assert {r.n_dropped for r in out} == {3}


def test_every_frequent_line_passes_its_filter(spark):
    """At this size too: the filters let all frequent lines through and hardly any other."""
    from basketlens.llm.common import row_key
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    index = LineIndex(spark, 10).insert(docs)
    r1, r2 = row_key("doc_id", "text")
    passed = index.passed(docs.select(r1.alias("r1"), r2.alias("r2"), "text")).groupBy("h1", "h2").count()
    frequent = index.refs.filter("n >= 10")
    assert frequent.count() > 0
    assert frequent.join(passed, ["h1", "h2"], "left_anti").count() == 0
    assert passed.count() < frequent.count() + 0.01 * index.refs.count() + 5


def test_foreign_deletion_is_seen(spark):
    """Lines that other rows brought in don't make a row deletable."""
    schema = "doc_id long, text string"
    index = LineIndex(spark, 3).insert(spark.createDataFrame([(1, "x\ny"), (2, "z\nw"), (2, "z\nw")], schema))
    for rows in ([(1, "x\nz")], [(3, "x\ny")], [(1, "x\ny"), (1, "x\ny")]):
        with pytest.raises(ValueError):
            index.delete(spark.createDataFrame(rows, schema))
    left = index.delete(spark.createDataFrame([(2, "z\nw"), (1, "x\ny")], schema))
    assert left.rows.agg({"n": "sum"}).first()[0] == 1 and left.refs.count() == 2


def test_cuckoo_filter():
    rng = np.random.RandomState(3)
    keys = np.unique(rng.randint(-2 ** 62, 2 ** 62, 3000))
    f = CuckooFilter.sized(len(keys))
    assert f.add(keys) and f.has(keys).all()
    f.remove(keys[:1000])
    assert f.has(keys[1000:]).all() and f.has(keys[:1000]).mean() < 0.01
    full = CuckooFilter.sized(1)
    assert not full.add(keys)


def test_token_counts_of_all_short_strings():
    import itertools

    from sentencepiece import SentencePieceProcessor

    from basketlens.llm.token_counts import SegmentCounts
    model = open(P.path("piece_bpe_32k.model"), "rb").read()
    library, counts = SentencePieceProcessor(model_proto=model), SegmentCounts.of(model)
    texts = ["".join(x) for n in range(6) for x in itertools.product("a\u2581 \n\u00a0", repeat=n)]
    assert [counts.count(t) for t in texts] == [len(library.encode(t)) for t in texts]


def test_chunk_encoder_equals_the_library_on_odd_texts():
    import random

    from tokenizers import Tokenizer
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = f.read()
    encoder, library = token_files.ChunkEncoder.of(model, "<u2"), Tokenizer.from_str(model)
    rng = random.Random(5)
    letters = ["a", "b", " ", "  ", "\n", "\r", "'s", "1", "\u00e9", "\u65e5", "!", "<|endoftext|>", " \n", "\t", "\u0301", "\u00a0"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    want = [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.encode(t) for t in texts] == want


def test_token_counts(docs):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = Counter(map(tuple, count_tokens(docs, P.path("piece_bpe_32k.model"), 1000).collect()))
    want = Counter()
    for i, t in pairs(docs):
        n = len(sp.encode(t or ""))
        want[i, len((t or "").encode()), n, n > 1000] += 1
    assert got == want


def test_merge_takes_lowest_rank_then_leftmost():
    rank = {"ab": 2, "bc": 1, "abc": 3, "aa": 0}
    assert merge(list("abc"), rank) == ["a", "bc"] or merge(list("abc"), rank) == ["abc"]
    assert merge(list("aaa"), rank) == ["aa", "a"]
    assert merge([], rank) == [] and merge(["z"], rank) == ["z"]


def test_bpe_round_trip(docs):
    import tiktoken
    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_codec.read_ranks(path), special_tokens={})
    encoded = bpe_codec.encode(docs, path, P.PATTERN, block_size=3000, parts=5)
    rows = bpe_codec.decode(encoded, path).collect()
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in rows) == Counter(
        (i, tuple(enc.encode_ordinary(t or "")), (t or "").encode()) for i, t in pairs(docs))
    at_once = bpe_codec.encode(docs, path, P.PATTERN, block_size=3000, parts=5, decoded=True)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in at_once.collect()) == Counter(
        (r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in rows)


def test_rank_file(tmp_path):
    (tmp_path / "r").write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate([b"a", b"bc"])))
    assert bpe_codec.read_ranks(str(tmp_path / "r")) == {b"a": 0, b"bc": 1}


def test_token_files(spark, docs):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    to = token_files.new_files(spark)
    by_rank = token_files.write_token_files(docs, path, to, end_id=0, block_ids=5000)
    want, start = Counter(), 0
    read = token_files.read_token_files(spark, to, by_rank).orderBy("start").collect()
    assert [r.doc_id for r in read] == sorted((i for i, _ in pairs(docs)), key=lambda i: (i is not None, i or 0))
    for r in read:
        assert r.start == start
        start += len(r.ids)
        want[r.doc_id, tuple(r.ids)] += 1
    assert want == Counter((i, (*lib.encode(t or "", add_special_tokens=False).ids, 0)) for i, t in pairs(docs))
    digests = token_files.token_file_digests(spark, to, by_rank).collect()
    assert sorted((r.start, r.n_tokens, r.ids_crc32) for r in digests) == [
        (r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in read]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 1001])
def test_variable_length_coding(n):
    ranks = (2.0 ** np.random.RandomState(n).uniform(0, 32, n)).astype(np.uint32)
    control, data = token_files.pack(ranks)
    assert len(control) == -(-n // 4)
    assert (token_files.unpack(control, data, n) == ranks).all()


def test_empty_tables(no_docs, spark):
    assert quality_verdicts(no_docs).count() == 0
    assert dedup_lines(no_docs).count() == 0
    assert count_tokens(no_docs, P.path("piece_bpe_32k.model")).count() == 0
    assert bpe_codec.encode(no_docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0
    to = token_files.new_files(spark)
    by_rank = token_files.write_token_files(no_docs, P.path("byte_bpe_50k.json"), to)
    assert token_files.read_token_files(spark, to, by_rank).count() == 0


def test_text_queries_give_a_row_per_document(spark):
    n = small(spark).count()
    for name in ("op5_quality_rules", "op8_line_dedup", "op9_token_counts", "op10_bpe_codec", "op6_token_files"):
        out = queries.QUERIES[name](spark, SF_SMALL)
        assert out.select(F.countDistinct("doc_id"), F.count(F.lit(1))).first() == (n, n), name
