"""Toxicity of restored texts (operator 4).

Characters are counted over all documents for the character model; obfuscated
words are restored by it. Word and word-start weights come from labelled rows,
and a logistic regression turns a document's strongest weights into a score.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.deobfuscation import CLASSES, LOOKALIKES, CharacterModel, byte_classes, edge_free, restore, suspicious
from basketlens.llm.pretokens import Memo, rows_of

# The classifier is fitted on this many labelled documents at most, about (by a
# hash of the id); it keeps all weights that stand out there.
SAMPLE_DOCS = 20_000
# lengths of the word starts that count as features beside whole words
STARTS = (4, 5, 6)
N_FEATURES = 4
SURE = 2.5

_SINGLES = re.compile("1{3,}")
# where a written word may hold several: at any sign, or at signs that stand for no letter
_SIGNS = re.compile(r"[\W_]+")
_GAPS = re.compile("(?:(?![" + re.escape("".join(LOOKALIKES)) + r"])[\W_])+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def character_counts(docs: DataFrame) -> np.ndarray:
    """Counts of three character classes in a row over all texts. Each task sums
    its own; at most CLASSES ** 3 rows reach the driver, whatever the input."""
    def run(batches):
        classes = byte_classes()
        counts = np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = [t for t in batch.column("text").slice(at, 256).to_pylist() if t]
                for t in texts if sum(map(len, texts)) > 1 << 22 else [b" ".join(texts)]:
                    for low in range(0, len(t), 1 << 20):
                        c = classes[np.frombuffer(b"  " + t[max(0, low - 2):low + (1 << 20)] + b" ", np.uint8)]
                        counts += np.bincount(c[:-2] * CLASSES ** 2 + c[1:-1] * CLASSES + c[2:], minlength=CLASSES ** 3)
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["code", "n"])

    out = np.zeros(CLASSES ** 3, np.int64)
    for r in (docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "code long, n long")
              .groupBy("code").agg(F.sum("n").alias("n")).collect()):
        out[r["code"]] = r["n"]
    return out


class Restorer:
    """Restored words of written words, found once per distinct word of a task."""

    def __init__(self, model: CharacterModel):
        self.model = model

    def words(self, written: str) -> tuple[str, ...]:
        """The word restored as a whole, and its parts between signs."""
        word = edge_free(written)
        if not suspicious(word):
            return (word,) if word else ()
        out = dict.fromkeys(restore(word, self.model))
        for part in {*_SIGNS.split(word), *map(edge_free, _GAPS.split(word))} - {word}:
            if len(part) >= 3:
                out.update(dict.fromkeys(restore(part, self.model) if suspicious(part) else [part]))
        return tuple(out)

    def spaced(self, written: list[str]) -> list[str]:
        """Words spelled with spaces: runs of three or more single characters."""
        marks = "".join(["1" if len(w) == 1 else "0" for w in written])
        out = []
        for m in _SINGLES.finditer(marks):
            joined = "".join(written[m.start():m.end()])
            if len({c for c in joined if c.isalnum()}) >= 3:
                out += restore(joined, self.model, spaced=True)
        return out


def features_of(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in STARTS if len(word) > n)]


def _feature_counts(model, batches):
    """(feature, fold, toxic, n): documents that hold the feature, summed per batch."""
    restorer = Restorer(model.value)
    restored = Memo(restorer.words)
    for batch in batches:
        counts: dict = {}
        for texts, toxic, fold in rows_of(batch):
            for text, t, f in zip(texts, toxic, fold):
                written = (text or "").lower().split()
                words = {w for x in set(written) for w in restored[x]} | set(restorer.spaced(written))
                for feature in {y for w in words for y in features_of(w)}:
                    c = counts.setdefault((feature, f), [0, 0])
                    c[0] += t
                    c[1] += 1
        yield pa.record_batch(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()),
             pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())],
            ["feature", "fold", "toxic", "n"])


class Scorer:
    """The strongest weights of a text, from restored words."""

    def __init__(self, model: CharacterModel, weights: dict[str, float]):
        self.restorer, self.weights = Restorer(model), weights
        # starts of weighted words, to join words written in pieces
        self.whole = {w for w in weights if len(w) >= 4 and w.isalpha()}
        self.starts = {w[:n] for w in self.whole for n in range(1, len(w))}
        self.memo = Memo(lambda written: [(w, x) for w in self.restorer.words(written) if (x := self.weight(w)) > 0])

    def weight(self, word: str) -> float:
        return max((self.weights.get(f, 0.0) for f in features_of(word)), default=0.0)

    def joined(self, written: list[str]) -> list[str]:
        """Weighted words written in two or more pieces ('id iot'); a word that
        has a weight by itself is no piece."""
        out, first = [], self.starts.intersection(written)
        for at in [i for i, w in enumerate(written) if w in first] if first else ():
            word = written[at]
            # ends with the longest start at the latest
            for i in range(at + 1, len(written)) if word not in self.whole else ():
                piece = written[i]
                last = edge_free(piece)
                if word + last in self.whole and last not in self.whole:
                    out.append(word + last)
                word += piece
                if word not in self.starts:
                    break
        return out

    def features(self, text: str | None) -> list[float]:
        """Best, second and third weight of different restored words, and one."""
        written = (text or "").lower().split()
        hits = {}
        for found in filter(None, map(self.memo.__getitem__, written)):
            hits.update(found)
        for r in self.restorer.spaced(written) + self.joined(written):
            if (x := self.weight(r)) > 0:
                hits[r] = x
        return [*(sorted(hits.values(), reverse=True)[:3] + [0.0] * 3)[:3], 1.0]


def _lexicon(rows, toxic: int, clean: int) -> dict[str, float]:
    """Weights: smoothed log odds of a feature in toxic against clean documents,
    where they exceed SURE standard errors."""
    t, c = rows["toxic"], rows["n"] - rows["toxic"]
    w = np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))
    keep = (w > SURE * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))) & (t >= 3)
    return dict(zip(rows["feature"][keep], w[keep]))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the last column is the constant."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (y - p) - penalty * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, dict[str, float], np.ndarray]:
    """Character counts, weights and coefficients, from labelled rows that aren't
    held out. The coefficients are fitted on weights of the other half of the
    rows. Without both labels among them every score is the smoothed base rate."""
    spark = docs.sparkSession
    counts = character_counts(docs)
    model = spark.sparkContext.broadcast(CharacterModel(counts))
    marks = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("label_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("label_id"))).distinct()
    n = marks.count()
    share = min(1.0, SAMPLE_DOCS / max(1, n))
    marks = marks.filter(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < share * 1_000_000)
    train = docs.select("doc_id", "text").join(marks, F.col("doc_id") == F.col("label_id")).select(
        "text", "toxic", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(2)).cast("int").alias("fold"))
    # copies count once
    train = train.groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("fold").alias("fold"))
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in train.groupBy("fold", "toxic").count().collect()}
    toxic = sum(v for (f, t), v in sizes.items() if t == 1)
    clean = sum(v for (f, t), v in sizes.items() if t == 0)
    if not toxic or not clean:
        rate = (toxic + 1) / (toxic + clean + 2)
        return counts, {}, np.array([0.0] * (N_FEATURES - 1) + [np.log(rate / (1 - rate))])
    by_feature = (train.mapInArrow(lambda b: _feature_counts(model, b), "feature string, fold int, toxic long, n long")
                  .groupBy("feature").agg(
        *(F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}{f}") for f in (0, 1)
          for c in ("toxic", "n")))
                  .filter("toxic0 + toxic1 >= 3 and 4 * (toxic0 + toxic1) >= n0 + n1").toPandas())
    features = by_feature["feature"].to_numpy()

    def lexicon(folds):
        rows = {"feature": features, "toxic": sum(by_feature[f"toxic{f}"].to_numpy() for f in folds),
                "n": sum(by_feature[f"n{f}"].to_numpy() for f in folds)}
        return _lexicon(rows, sum(sizes.get((f, 1), 0) for f in folds), sum(sizes.get((f, 0), 0) for f in folds))

    halves = spark.sparkContext.broadcast([lexicon([1]), lexicon([0])])

    def features_by_fold(batches):
        scorers = [Scorer(model.value, w) for w in halves.value]
        for batch in batches:
            for texts, labels_, folds in rows_of(batch):
                x = [scorers[f].features(t) for t, f in zip(texts, folds)]
                yield pa.record_batch([pa.array(x, pa.list_(pa.float64())), pa.array(labels_, pa.int32())], ["x", "y"])

    rows = train.mapInArrow(features_by_fold, "x array<double>, y int").toPandas()
    x = np.array(rows["x"].tolist())
    y = rows["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))
    return counts, lexicon([0, 1]), _logistic(x[order], y[order])


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs`` (doc_id, text).

    Scores use the text only. Null and empty texts get the score of a text
    without any weighted word. Repeated rows get equal scores; a null doc_id is
    not held out and has no label; an empty table gives no rows. Labels other
    than 0 and 1 are ignored; a text with both labels counts as toxic.
    """
    counts, weights, beta = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((counts, weights, beta))

    def run(batches):
        counts, weights, beta = shared.value
        scorer = Scorer(CharacterModel(counts), weights)
        for batch in batches:
            for ids, texts in rows_of(batch):
                x = np.array([scorer.features(t) for t in texts])
                p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(p)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
