from __future__ import annotations

import pytest

SF_SMALL = "/root/testdata/sf0.001"

# names that the operators use for columns of their own
CLASHES = ["size", "r1", "r2", "n", "word", "key", "cid", "node", "root", "shard", "part", "kept", "host", "block",
           "slot", "ids", "t", "w", "s", "k", "pq", "z", "lines", "start", "bucket", "u", "target", "toxic", "fold",
           "kept_text", "n_lines", "size_class", "rank", "b", "v", "score", "label_id", "sketch", "taken", "parts"]

PROSE = ("The committee met on Tuesday to discuss the harbour works and the cost of the new bridge over the "
         "river while several members asked for more time to read the long report that the engineers had sent "
         "in late spring about the state of the old piers and the road that leads down to the water from town. ")


def edge_rows():
    rows = [(i, PROSE + f"Entry number {i} of the register was signed by clerk {i * 7}.\nfooter line\n", "a")
            for i in range(14)]
    rows += [
        (20, None, "a"), (21, "", "b"), (22, " \t\n\x0b ", "b"), (23, "one two three", None), (24, "ONE two three", "c"),
        (25, "Footer LINE  \nx", "b"), (26, "\n\n\n", "c"), (27, "a b a b a b a b a b", "c"),
        (None, "no id here " * 20, "a"), (None, None, None), (28, "repeat me " * 30, "d"), (28, "repeat me " * 30, "d"),
        (29, "x" * 70_000, "d"), (30, " ".join(f"w{i % 977}" for i in range(30_000)), "a"),
        (31, "naïve façade — 日本語 テキスト 😀😀  double  spaces\r\nand\ttabs", None),
        (32, "don't  we'll\n\n  it's <|endoftext|> ok now", "b"), (33, "### $$$ || <b> &amp; ***", "b"),
        (34, (PROSE * 2).upper(), "c"), (35, PROSE * 2, "c"),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(edge_rows(), "doc_id long, text string, source string").repartition(3, "source", "text")
    return docs.select("*", *(F.lit(f"clash {c}").alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string")
