"""Quality by supervised subword embeddings (operator 11).

A text's features are its words, pairs of neighbouring words (a word and itself
again is one pair, whatever the word) and the character n-grams of its words, hashed
to rows of one table of learned vectors. The vectors are averaged per document; a softmax layer gives the label. Vectors and layer are
trained together by stochastic gradient descent in numpy, on a bounded sample of
labelled rows. For two labels the layer acts on an average, so a score needs only
one number per table row: its vector times the difference of the output rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import give_back
from basketlens.llm.toxicity import held_out

# The classifier is fitted on this many labelled documents, about (by a hash of the id).
SAMPLE_DOCS = 4_000
# rows of the table per kind of feature: character n-grams, words, word pairs
BITS = 16
BUCKETS = 1 << BITS
NGRAMS = (3, 4)
DIMENSIONS = 10
EPOCHS = 5
RATE = 1.0
# bytes that are hashed at a time
PIECE = 1 << 20
# numbers of the folded table are kept in units of 2**-UNIT_BITS: sums are exact, so
# the order of a text's features never shows
UNIT_BITS = 30

# White space of the word rule, odd multipliers of the hashes.
_BLANK = bytes(32 if b in (32, 9, 10, 11, 12, 13) else b for b in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _STEP
    return (h >> np.uint64(64 - BITS)).astype(np.int64) + kind * BUCKETS


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
    up, down = np.full(n, _STEP, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Features:
    """Table rows of the features of byte texts, many short texts at a time."""

    def __init__(self):
        self.up, self.down = _powers(PIECE)

    def pieces(self, texts: list[bytes]):
        """(texts' numbers, padded bytes, bounds, whether the first goes on from the
        piece before): pieces of about PIECE bytes, cut at blanks only."""
        group, size = [], 0
        for i, text in enumerate(texts):
            text = (text or b"").translate(_BLANK)
            if size + len(text) > PIECE // 2 and group:
                yield group
                group, size = [], 0
            low = 0
            while len(text) - low > PIECE // 2:
                cut = text.rfind(b" ", low, low + PIECE // 2)
                cut = cut if cut > low else text.find(b" ", low + PIECE // 2)
                if cut < 0:
                    break
                yield [(i, text[low:cut], low > 0)]
                low = cut + 1
            group.append((i, text[low:], low > 0))
            size += len(text) - low
        if group:
            yield group

    def rows(self, texts: list[bytes]):
        """(text's number, table rows) arrays, some per piece."""
        last = None
        for group in self.pieces(texts):
            data = np.frombuffer(b" " + b" ".join(t for _, t, _ in group) + b" ", np.uint8)
            if len(data) > len(self.up):
                self.up, self.down = _powers(2 * len(data))
            owner = np.array([i for i, _, _ in group])
            ends = np.cumsum([len(t) + 1 for _, t, _ in group])
            inner = data != 32
            byte = data.astype(np.uint64) + np.uint64(1)
            for kind, n in enumerate(NGRAMS):
                if len(data) < n:
                    continue
                # no blank but at the ends, where it marks the border of a word
                fits = inner[1:len(data) - n + 2].copy()
                for t in range(2, n - 1):
                    fits &= inner[t:len(data) - n + 1 + t]
                at = np.flatnonzero(fits[:len(data) - n + 1])
                h = byte[at]
                for t in range(1, n):
                    h = h * _STEP + byte[at + t]
                yield owner[np.searchsorted(ends, at, side="right").clip(max=len(owner) - 1)], _bucket(
                    h + np.uint64(n), 0)
            edge = np.flatnonzero(np.diff(inner.astype(np.int8)))
            starts, stops = edge[::2] + 1, edge[1::2] + 1
            if not len(starts):
                continue
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(byte * self.up[:len(byte)], dtype=np.uint64)))
            word = (sums[stops] - sums[starts]) * self.down[starts]
            of = owner[np.searchsorted(ends, starts, side="right").clip(max=len(owner) - 1)]
            yield of, _bucket(word, 1)
            if group[0][2] and last and last[1] == group[0][0]:
                word, of = np.concatenate(([last[0]], word)), np.concatenate(([last[1]], of))
            same = of[1:] == of[:-1]
            # all pairs of a word and itself share one row
            pair = np.where(word[:-1] == word[1:], _STEP, word[:-1] * _MIX + word[1:])
            yield of[1:][same], _bucket(pair[same], 2)
            last = word[-1], of[-1]

    def counted(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Distinct table rows of one text and their numbers; at most one per table row."""
        counts = np.zeros(3 * BUCKETS, np.int64)
        for _, rows in self.rows([text]):
            counts += np.bincount(rows, minlength=3 * BUCKETS)
        used = np.flatnonzero(counts)
        return used, counts[used]


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> np.ndarray:
    """The folded table: SGD over documents in seeded order, linearly falling rate."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (3 * BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((2, DIMENSIONS), np.float32)
    done, total = 0, EPOCHS * len(rows)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            used, n = rows[i]
            rate = RATE * (1 - done / total)
            done += 1
            share = (n / n.sum()).astype(np.float32)
            mean = share @ table[used]
            z = output @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ output
            output -= rate * np.outer(p, mean)
            table[used] -= rate * share[:, None] * back
    return np.rint((table @ (output[1] - output[0])).astype(np.float64) * 2.0 ** UNIT_BITS).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, label: str) -> tuple[np.ndarray, float]:
    """(folded table, base rate's logit), from labelled rows that aren't held out. The
    features are found where the texts are; one task trains on the bounded sample."""
    marks = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(label).cast("int").alias("label")).filter(
        F.col("label_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("label_id"))).groupBy(
        "label_id").agg(F.max("label").alias("label"))
    share = min(1.0, SAMPLE_DOCS / max(1, marks.count()))
    marks = marks.filter(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < share * 1_000_000)

    def featured(batches):
        features = Features()
        for batch in batches:
            for doc_id, text, y in zip(*(batch.column(c) for c in ("doc_id", "text", "label"))):
                used, n = features.counted(text.as_py() or b"")
                yield pa.record_batch([pa.array([doc_id.as_py()]), pa.array([y.as_py()], pa.int32()),
                                       pa.array([used.astype(np.int32)], pa.list_(pa.int32())),
                                       pa.array([n], pa.list_(pa.int64()))], ["doc_id", "label", "used", "n"])

    def trained(table: pa.Table) -> pa.Table:
        used, n = table.column("used").combine_chunks(), table.column("n").combine_chunks()
        rows = [(used[i].values.to_numpy(), n[i].values.to_numpy()) for i in range(table.num_rows)]
        y = table.column("label").to_numpy()
        ids = table.column("doc_id").to_numpy()
        order = sorted((i for i in range(len(rows)) if len(rows[i][0])),
                       key=lambda i: (ids[i], y[i], len(rows[i][0]), rows[i][1].tobytes()[:64]))
        ones = int(y.sum())
        base = float(np.log((ones + 1) / (len(y) - ones + 1)))
        folded = train([rows[i] for i in order], y[order]) if 0 < ones < len(y) else np.zeros(0, np.int64)
        return pa.table({"folded": pa.array([folded], pa.list_(pa.int64())), "base": [base]})

    sample = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(
        marks, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "label").mapInArrow(
        featured, "doc_id long, label int, used array<int>, n array<long>")
    out = sample.groupBy().applyInArrow(trained, "folded array<long>, base double").first()
    return (np.array(out["folded"], np.int64), out["base"]) if out else (np.zeros(0, np.int64), 0.0)


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs`` (doc_id, text).

    Scores use the text only. Null, empty and blank texts get the smoothed base
    rate; without both labels every text does (0.5 without any). Repeated rows get
    equal scores; a null doc_id is not held out and has no label; an empty table
    gives no rows. Labels other than 0 and 1 are ignored; of two labels for one
    doc_id the larger counts. Clashing further columns are not read.
    """
    folded, base = fit(docs, labels, label)
    shared = docs.sparkSession.sparkContext.broadcast((folded, base))

    def run(batches):
        folded, base = shared.value
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sums, n = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                for of, rows in features.rows(part.column("text").to_pylist()) if len(folded) else ():
                    # texts come in order: sums over the stretch of each
                    first = np.flatnonzero(np.diff(of, prepend=-1))
                    if len(first):
                        sums[of[first]] += np.add.reduceat(folded[rows], first)
                        n[of[first]] += np.diff(first, append=len(of))
                z = np.where(n > 0, sums / 2.0 ** UNIT_BITS / np.maximum(n, 1), base)
                yield pa.record_batch([part.column("doc_id"), pa.array(1 / (1 + np.exp(-z)))], ["doc_id", "score"])
        del features
        give_back()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, score double").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= least).cast("int").alias("predicted"))
