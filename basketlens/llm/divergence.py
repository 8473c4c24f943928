"""Source divergence audit (operator 13).

Every (lang, source) group gets a smoothed share for each kept term of its lang;
groups are compared by the summed divergence of their shares, and with the whole
lang term by term. The comparison is a cube: sources are cut into blocks, terms
into blocks, and a task owns one (source block, source block, term block) cell. It
holds a slice of two source blocks, compares their groups over the slice's terms,
and partial divergences are summed along the term axis.

All arithmetic is on integers: shares in units of 1e-9 by decimal division,
divergences in 64 bits.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import lookup_join, stored
from basketlens.llm.pretokens import rows_of

# distinct (group, term) entries that a task counts before it hands them on
COUNTED_TERMS = 300_000
# sources and terms of a block, about: a cell holds 2 x SOURCES x TERMS shares at most, about
SOURCES = 8
TERMS = 10_000

# Parts of a share, and what is added to a count.
SCALE = 1_000_000_000
ADDED = 2

# UTF-8 bytes -> lower-cased term byte or space; terms are A-Z, a-z and all beyond ASCII
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def group_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of each term in each
    group of ``docs`` (text, lang, source without nulls). Tasks count before the shuffle."""
    def run(batches):
        n: dict = {}
        df: dict = {}

        def out():
            cols = [[], [], [], [], []]
            for group, counts in n.items():
                cols[0] += [group[0]] * len(counts)
                cols[1] += [group[1]] * len(counts)
                cols[2] += [t.decode() for t in counts]
                cols[3] += counts.values()
                cols[4] += map(df[group].__getitem__, counts)
            kinds = [pa.string()] * 3 + [pa.int64()] * 2
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], ["lang", "source", "term", "n", "df"])

        for batch in batches:
            for texts, langs, sources in rows_of(batch):
                for text, *group in zip(texts, langs, sources):
                    terms = Counter(text.translate(_TERMS).split())
                    group = tuple(group)
                    n.setdefault(group, Counter()).update(terms)
                    df.setdefault(group, Counter()).update(terms.keys())
                if sum(map(len, n.values())) > COUNTED_TERMS:
                    yield out()
                    n.clear()
                    df.clear()
        yield out()

    return (docs.select(F.col("text").cast("binary"), "lang", "source")
            .mapInArrow(run, "lang string, source string, term string, n long, df long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")))


def _share(count: str, total: str, kept: str):
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * kept)), exact beyond 64 bits."""
    return F.expr(f"1L + coalesce((cast({count} + {ADDED} as decimal(20,0)) * {SCALE}BD) "
                  f"div nullif(cast({total} + {ADDED} * {kept} as decimal(20,0)), 0BD), 0L)")


def _gap(p: str, q: str):
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so 64 bits hold the square."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def kept_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, source, term, n, lang_n, first): counts of the terms in ``least``
    documents of their lang or more; ``first`` is 1 on one row of each (lang, term)."""
    term = Window.partitionBy("lang", "term")
    return group_terms(docs).select(
        "lang", "source", "term", "n", F.sum("df").over(term).alias("lang_df"), F.sum("n").over(term).alias("lang_n"),
        (F.col("source") == F.min("source").over(term)).cast("long").alias("first")).filter(
        F.col("lang_df") >= least).drop("lang_df")


def group_totals(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per occurring (lang, source): rows of its counts (``weight``), its
    total, the lang's total and kept terms, its share of a term it lacks (``p0``)."""
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("weight"),
                                                F.sum("first").alias("first"))
    langs = sums.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("first").alias("kept"))
    groups = docs.select("lang", "source").distinct()
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = {"total": 0, "weight": 0, "lang_total": 0, "kept": 0}
    # tables of one row per lang: no skew, as groups of a lang are distinct rows
    return (groups.join(sums.drop("first"), ["lang", "source"], "left").join(langs, "lang", "left")
            .join(sources, "lang").fillna(zero).withColumn("p0", _share("0", "total", "kept")))


def _cell(lang: str, within: bool, rows: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of one cell, of its two source blocks or
    ``within`` one; rows are (source, side, term, p, kept), a null term gives the
    source's share of any term it lacks here."""
    source = rows.column("source").to_pylist()
    term = rows.column("term").combine_chunks()
    side = rows.column("side").to_numpy()
    p = rows.column("p").to_numpy()
    marker = term.is_null().to_numpy(zero_copy_only=False)
    names = sorted({(source[i], side[i]) for i in np.flatnonzero(marker).tolist()})
    at = {s: i for i, (s, _) in enumerate(names)}
    group = np.fromiter((at[s] for s in source), np.int64, len(source))
    code = term.dictionary_encode()
    seen = len(code.dictionary)
    p0 = np.zeros(len(names), np.int64)
    p0[group[marker]] = p[marker]
    shares = np.repeat(p0[:, None], seen, axis=1)
    entry = np.flatnonzero(~marker)
    shares[group[entry], code.indices.to_numpy(zero_copy_only=False)[entry].astype(np.int64)] = p[entry]
    out = []
    for i, (a, side_a) in enumerate(names):
        others = [j for j in range(len(names)) if (j > i if within else names[j][1] > side_a)]
        if others:
            d = shares[others] - shares[i]
            sums = ((d * d) // (shares[others] + shares[i])).sum(axis=1)
            out += [(a, names[j][0], s, int(p0[i]), int(p0[j])) for j, s in zip(others, sums.tolist())]
    kept = rows.column("kept")[0].as_py()
    schema = pa.schema([(c, pa.string()) for c in ("lang", "a", "b")] +
                       [(c, pa.int64()) for c in ("value", "pa", "pb", "seen", "kept")])
    return pa.Table.from_pylist(
        [dict(zip(schema.names, (lang, *row, seen, kept))) for row in out], schema)


def pair_divergences(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a lang, by
    the cube. ``shares``: (lang, source, term, p); ``groups``: group_totals()."""
    blocked = groups.select(
        "lang", "source", "p0", "kept", "weight", F.ceil(F.col("sources") / SOURCES).cast("int").alias("s_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("kept") / TERMS)).cast("int").alias("t_blocks")).withColumn(
        "own", F.pmod(F.xxhash64("source"), F.col("s_blocks")).cast("int"))
    blocked = stored(blocked, "divergence-groups")
    entries = lookup_join(shares, blocked, ["lang", "source"], "weight").select(
        "lang", "source", "own", "s_blocks", F.pmod(F.xxhash64("term"), F.col("t_blocks")).cast("int").alias("t_block"),
        "term", "p", "kept")
    markers = blocked.select("lang", "source", "own", "s_blocks",
                             F.explode(F.sequence(F.lit(0), F.col("t_blocks") - 1)).alias("t_block"),
                             F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "kept")
    # a slice goes to the cells of its source block with every block of the lang
    dealt = entries.unionByName(markers).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("s_blocks") - 1))).select(
        "lang", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "t_block", "source",
        (F.col("own") > F.col("other")).cast("int").alias("side"), "term", "p", "kept")
    partial = dealt.groupBy("lang", "i", "j", "t_block").applyInArrow(
        lambda key, rows: _cell(key[0].as_py(), key[1] == key[2], rows),
        "lang string, a string, b string, value long, pa long, pb long, seen long, kept long")
    # terms that neither block holds anywhere in a cell count with both default shares
    whole = partial.groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.max("kept").alias("kept"), F.max("pa").alias("pa"),
        F.max("pb").alias("pb")).withColumn("value", F.col("value") + (F.col("kept") - F.col("seen")) * _gap("pa", "pb"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s")
    return whole.select("lang", both, "value").select("lang", "s.source", "s.item", "value")


def source_divergence(docs: DataFrame, least: int = 10, ranks: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank of ``docs`` (text, lang, source).

    Nulls count as ''. Part ``pair`` compares each group with the other sources of
    its lang, part ``term`` lists the ``ranks`` kept terms that it uses more than
    its lang. Empty and null texts have no terms, but their group is compared;
    repeated rows count each time; a lang with one source has no pairs; an empty
    table gives no rows; further columns are not read.
    """
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    counts = stored(kept_counts(docs, least), "divergence-counts")
    groups = stored(group_totals(docs, counts), "divergence-totals")
    shares = lookup_join(counts, groups, ["lang", "source"], "weight").select(
        "lang", "source", "term", _share("n", "total", "kept").alias("p"),
        _share("lang_n", "lang_total", "kept").alias("q"))
    shares = stored(shares, "divergence-shares")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_divergences(shares.drop("q"), groups).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    terms = shares.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks)
    return pairs.unionByName(terms)
