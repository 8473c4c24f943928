"""Spelling variant grouping (operator 12).

Words that differ by one code point are found by search schemes over FM-indexes
of the delimited vocabulary. A word cut into two halves and its near word share
at least one half: either the first half matches exactly from the word's start
and the search is extended to the right with one error, or the last half matches
exactly from the word's end and the search is extended to the left. Every step
maps an interval of suffix ranks to the interval of the longer string.

The vocabulary is dealt by halves: a word is indexed under each start (and end)
that can be the exact half of a word at most one code point longer or shorter,
and searches under its own two halves. A shard indexes the words of many halves;
halves with more than BLOCK_WORDS words are cut into blocks, each of which their
searches visit.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import stored
from basketlens.llm.pretokens import rows_of

# distinct words that a task counts before it hands them on
COUNTED_WORDS = 300_000
# index and search rows of a shard, about; words of one half in a block
SHARD_ROWS = 60_000
BLOCK_WORDS = 50_000
# searches that go through the index side by side
SEARCHES = 1 << 15

# One occurrence in DAMAGE loses a code point.
DAMAGE = 199

# Latin-1 bytes -> lower-cased letter or space; letters are A-Z, a-z and U+00C0 to U+00FF
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))
# Latin-1 letter -> 1.. in code-point order; 0 is the delimiter
_CODES = np.zeros(256, np.int64)
_CODES[[*range(97, 123), *range(192, 256)]] = range(1, 91)
SYMBOLS = 91


def words_of(doc_id, text: str | None, shortest: int) -> dict[bytes, int]:
    """Latin-1 words of a text with their numbers, after the damage rule; words
    of fewer than ``shortest`` code points are left out."""
    counts: dict[bytes, int] = {}
    runs = (text or "").encode("latin-1", "replace").translate(_LETTERS).split()
    for run in runs:
        if len(run) >= shortest:
            counts[run] = counts.get(run, 0) + 1
    start = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
    hashes = ((run, zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)) for run in counts)
    hit = [(run, h % len(run)) for run, h in hashes if h % DAMAGE == 0]
    for word, n in [(run[:at] + run[at + 1:], counts.pop(run)) for run, at in hit]:
        if len(word) >= shortest:
            counts[word] = counts.get(word, 0) + n
    return counts


def vocabulary(docs: DataFrame, shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n) of all texts: distinct words of ``shortest`` code points or more
    with ``least`` occurrences or more. A null doc_id counts as an empty one."""
    def run(batches):
        counts: dict[bytes, int] = {}

        def out():
            return pa.record_batch([pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                    pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for ids, texts in rows_of(batch):
                for doc_id, text in zip(ids, texts):
                    for word, n in words_of(doc_id, text, shortest).items():
                        counts[word] = counts.get(word, 0) + n
                    if len(counts) > COUNTED_WORDS:
                        yield out()
                        counts.clear()
        yield out()

    return (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


class FmIndex:
    """Suffix ranks of the text ``$ w1 $ w2 $ ...`` (cyclic, $ is the delimiter)
    written backwards, so that a backward step extends a match to the right.

    The positions of each symbol in the last column, sorted by (symbol, position),
    turn a step into one binary search per bound.
    """

    def __init__(self, words: list[bytes]):
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = _CODES[np.frombuffer(b"".join(b"\0" + w for w in words), np.uint8)]
        self.size = n = len(text)
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        text = text[::-1]
        rank, order = _rotation_ranks(text)
        self.last = text[order - 1]
        by_symbol = np.argsort(self.last, kind="stable")
        self.keys = self.last[by_symbol] * (n + 1) + by_symbol
        # the delimiter before a word lies at the end of the reversed word; a match
        # that ends in the next delimiter starts (read backwards) at that one
        self.word_at = np.full(n, -1, np.int64)
        self.word_at[rank[n - 1 - np.roll(starts, -1)]] = np.arange(len(words))

    def extend(self, low, high, symbol):
        """Intervals of the strings one symbol longer."""
        base = symbol * (self.size + 1)
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def followers(self, low, high):
        """(state, letter) of every letter that follows some match of a state."""
        sizes = high - low
        few = np.flatnonzero(sizes <= SYMBOLS)
        many = np.flatnonzero(sizes > SYMBOLS)
        n = sizes[few]
        state = np.repeat(few, n)
        row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[few], n)
        found = np.unique(state * SYMBOLS + self.last[row])
        found = np.concatenate((found, (many[:, None] * SYMBOLS + np.arange(SYMBOLS)).ravel()))
        found = found[found % SYMBOLS > 0]
        return found // SYMBOLS, found % SYMBOLS


def _rotation_ranks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each rotation of ``text`` and the rotations in order, by doubling."""
    n = len(text)
    key = np.zeros(n, np.int64)
    for t in range(8):
        key = key << 7 | np.roll(text, -t)
    width = 8
    while True:
        order = np.argsort(key, kind="stable")
        steps = np.diff(key[order], prepend=key[order[0]]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(steps)
        if rank[order[-1]] == n - 1 or width >= n:
            return rank, order
        key = rank * n + np.roll(rank, -width)
        width *= 2


def search(index: FmIndex, patterns: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, word) of the words that start with the first ``half`` letters of a
    pattern (rows of ``patterns``, all of one length) and differ by one letter
    replaced, added or left out after them. Each such pair comes once: an added
    letter differs from the pattern's next one, of a run of equal letters the
    last is left out."""
    total, length = patterns.shape
    q = np.arange(total)
    low, high = index.extend(np.zeros(total, np.int64), np.full(total, index.size), np.zeros(total, np.int64))

    def kept(q, low, high):
        alive = np.flatnonzero(low < high)
        return q[alive], low[alive], high[alive]

    for j in range(half):
        q, low, high = kept(q, *index.extend(low, high, patterns[q, j]))
    erred = (q[:0], low[:0], high[:0])
    for j in range(half, length + 1):
        state, letter = index.followers(low, high)
        if j < length:
            other = letter != patterns[q[state], j]
            state, letter = state[other], letter[other]
        grown = (q[state], *index.extend(low[state], high[state], letter))
        # with a letter added, the pattern goes on at the same place
        erred = tuple(map(np.concatenate, zip(erred, grown)))
        if j == length:
            break
        erred = kept(erred[0], *index.extend(*erred[1:], patterns[erred[0], j]))
        left = (np.flatnonzero(patterns[q, j] != patterns[q, j + 1]) if j + 1 < length else np.arange(len(q)))
        # replaced, or left out: one place on
        erred = tuple(map(np.concatenate, zip(erred, grown, (q[left], low[left], high[left]))))
        q, low, high = kept(q, *index.extend(low, high, patterns[q, j]))
    q, low, high = kept(erred[0], *index.extend(*erred[1:], np.zeros(len(erred[0]), np.int64)))
    return q, index.word_at[low]


def search_shard(side: int, rows: pa.Table):
    """Near pairs of one shard: rows are (word, n, block, blocks); those with a
    null ``block`` are indexed, the others search. The last half is matched and
    extended to the left by searching the words written backwards."""
    word = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
    block = rows.column("block").to_pylist()
    n = rows.column("n").to_pylist()
    blocks = rows.column("blocks").to_pylist()
    turn = (lambda w: w[::-1]) if side else (lambda w: w)
    held = {w: x for w, x, b in zip(word, n, block) if b is None}
    names = sorted(held)
    by_length: dict[int, list[int]] = {}
    for i, b in enumerate(block):
        if b is not None:
            by_length.setdefault(len(word[i]), []).append(i)
    if not names or not by_length:
        return
    index = FmIndex([turn(w) for w in names])
    for length, at in sorted(by_length.items()):
        first = length // 2
        step = max(1, min(SEARCHES, (1 << 22) // length))
        for low in range(0, len(at), step):
            some = at[low:low + step]
            letters = _CODES[np.frombuffer(b"".join(turn(word[i]) for i in some), np.uint8)].reshape(-1, length)
            q, found = search(index, letters, length - first if side else first)
            pairs = []
            for i, f in zip(map(some.__getitem__, q.tolist()), map(names.__getitem__, found.tolist())):
                # the other side finds those; the other blocks of a half have theirs
                if (side and f.startswith(word[i][:first])) or (
                        blocks[i] > 1 and zlib.crc32(f) % blocks[i] != block[i]):
                    continue
                pairs.append((word[i].decode("latin-1"), f.decode("latin-1"), held[f]))
            if pairs:
                yield pa.Table.from_arrays(
                    [pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs]),
                     pa.array([p[2] for p in pairs], pa.int64())], ["word", "near", "near_n"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every ordered pair of words of ``words`` (word, n;
    a stored table of distinct words) that differ by exactly one inserted,
    deleted or replaced code point, once."""
    shards = max(1, -(-6 * words.count() // SHARD_ROWS))
    length = F.length("word")
    # lengths of the first half of a word one shorter, as long, one longer; the rest is the last half
    lengths = F.array_distinct(F.array(*(F.floor((length + d) / 2).cast("int") for d in (-1, 0, 1))))
    rest = F.array_distinct(F.array(*(F.ceil((length + d) / 2).cast("int") for d in (-1, 0, 1))))

    indexed = words.select("word", "n", F.lit(0).alias("side"), F.explode(lengths).alias("k")).select(
        "word", "n", "side", F.col("word").substr(F.lit(1), F.col("k")).alias("half")).unionByName(
        words.select("word", "n", F.lit(1).alias("side"), F.explode(rest).alias("k")).select(
            "word", "n", "side", F.expr("right(word, k)").alias("half")))
    asking = words.select("word", "n", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.expr("left(word, floor(length(word) / 2))").alias("half")),
        F.struct(F.lit(1).alias("side"), F.expr("right(word, ceil(length(word) / 2))").alias("half")))).alias("s")
        ).select("word", "n", "s.side", "s.half")
    # at most one in BLOCK_WORDS of the indexed rows' number: a bounded broadcast
    hot = F.broadcast(indexed.groupBy("side", "half").count().filter(F.col("count") > BLOCK_WORDS).select(
        "side", "half", F.ceil(F.col("count") / BLOCK_WORDS).cast("int").alias("blocks")))
    crc = F.crc32(F.encode("word", "iso-8859-1"))
    one = F.coalesce(F.col("blocks"), F.lit(1))
    indexed = indexed.join(hot, ["side", "half"], "left").withColumn("blocks", one).select(
        "word", "n", "side", "half", (crc % F.col("blocks")).cast("int").alias("at"), F.lit(None).cast("int").alias("block"),
        "blocks")
    asking = asking.join(hot, ["side", "half"], "left").withColumn("blocks", one).select(
        "word", "n", "side", "half", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at"),
        F.col("at").alias("block"), "blocks")
    dealt = indexed.unionByName(asking).withColumn(
        "shard", F.pmod(F.xxhash64("side", "half", "at"), F.lit(shards)).cast("int"))

    def run(key, rows):
        out = list(search_shard(key[0].as_py(), rows))
        return pa.concat_tables(out) if out else pa.table(
            {"word": pa.array([], pa.string()), "near": pa.array([], pa.string()), "near_n": pa.array([], pa.int64())})

    return dealt.select("side", "shard", "word", "n", "block", "blocks").groupBy("side", "shard").applyInArrow(
        run, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the rows (word, form): the last word that forms lead to.
    Every round doubles the way a root lies ahead; n grows fivefold with each
    form, so few rounds are needed."""
    out = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        out = stored(out.select("word", "root").join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not out.filter("moved").limit(1).count():
            return out.select("word", "root")
        out = out.select("word", "root")


def spelling_variants(docs: DataFrame, shortest: int = 6, least: int = 5, ratio: int = 5) -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of ``docs`` (doc_id, text).

    A word's form is its near word of largest n (ties: smallest), if that n is
    ``ratio`` times its own or more. Null and empty texts have no words, repeated
    rows count each time, an empty table gives no rows; further columns are not
    read.
    """
    words = stored(vocabulary(docs, shortest, least), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = F.col("best").isNotNull() & (-F.col("best.minus") >= ratio * F.col("n"))
    out = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n")),
        "spelling-forms")
    last = roots(out.filter(F.col("form").isNotNull()))
    return out.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
