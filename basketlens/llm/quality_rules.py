"""Quality rules with host verdicts (operator 5), DataFrame functions only.

Per document: word, symbol, repeated-line and repeated-window counts over the
whole text. Rule failures are summed per host, the host's failure rate is
shrunk towards all hosts by a beta prior fitted to the hosts (method of
moments), and the verdict joins back to the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import SPACE_CHARS, WORD, row_key, stored

# The symbols that count, and the base rule's limits.
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# low bits of a packed window entry hold its position; the rest hold the hash
POSITION_BITS = 24
POSITIONS = (1 << POSITION_BITS) - 1



def text_counts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): its row key r1, r2 and
    the counts as longs.

    n_repeat_words counts the word positions that lie in a 3-word window found
    at least twice. Windows are sorted as (hash prefix, position) longs; equal
    neighbours are then compared word by word, and a document where a hash
    prefix stands for two different windows is done over by the words
    themselves, so the count is exact for every text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    r1, r2 = row_key("doc_id", "source", "text")
    words = docs.select(r1.alias("r1"), r2.alias("r2"), "doc_id", F.col("source").alias("host"),
                        text.alias("t")).withColumn(
        "w", F.expr(f"regexp_extract_all(t, '{WORD}', 0)".replace("\\", "\\\\")))
    base = words.select(
        "r1", "r2", "doc_id", "host", "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n", -1),
                 lambda x: F.length(F.trim(x, F.lit(SPACE_CHARS))) > 0).alias("lines"))
    packed = base.withColumn(
        "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).withColumn(
        "s", F.expr(f"""sort_array(if(size(w) >= 3,
            transform(sequence(0, size(w) - 3),
                      i -> (xxhash64(w[i], w[i + 1], w[i + 2]) & {~POSITIONS}L) | i),
            cast(array() as array<bigint>)))"""))
    hits = packed.withColumn("k", F.expr(f"""if(size(s) >= 2,
        filter(sequence(1, size(s) - 1),
               k -> shiftright(s[k], {POSITION_BITS}) = shiftright(s[k - 1], {POSITION_BITS})),
        cast(array() as array<int>))"""))
    pairs = hits.withColumn("pq", F.expr(f"""transform(k, k -> struct(
        cast(s[k] & {POSITIONS}L as int) as p, cast(s[k - 1] & {POSITIONS}L as int) as q))"""))
    mixed = F.expr(f"""size(w) > {POSITIONS} or exists(pq, x -> not (
        w[x.p] = w[x.q] and w[x.p + 1] = w[x.q + 1] and w[x.p + 2] = w[x.q + 2]))""")
    # by the words themselves: windows sorted as structs, equal neighbours marked
    exact = """transform(sort_array(transform(sequence(0, size(w) - 3),
        i -> struct(w[i] as a, w[i + 1] as b, w[i + 2] as c, i as i))), x -> x)"""
    pairs = pairs.withColumn("z", F.when(mixed, F.expr(exact))).withColumn("pq", F.expr("""if(z is null, pq,
        transform(filter(sequence(1, size(z) - 1),
                         k -> z[k].a = z[k - 1].a and z[k].b = z[k - 1].b and z[k].c = z[k - 1].c),
                  k -> struct(z[k].i as p, z[k - 1].i as q)))"""))
    covered = "flatten(transform(pq, x -> array(x.p, x.p + 1, x.p + 2, x.q, x.q + 1, x.q + 2)))"
    return pairs.select("r1", "r2", "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        F.expr(f"cast(size(array_distinct({covered})) as bigint)").alias("n_repeat_words"),
                        F.size("lines").cast("long").alias("n_lines"))


def rule_flags(counts: DataFrame) -> DataFrame:
    """base_failed, and what the method's own rules say: ``severe`` alone
    rejects, ``weak`` (tables, lists and code have such counts as well) rejects
    only on a host with a bad verdict."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    mean_length = F.col("word_chars") / words
    return (counts
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
            .withColumn("severe", (F.col("n_symbols") > words)
                        | ((F.col("n_dup_lines") > 0.6 * lines) & (F.col("n_dup_lines") >= 5))
                        | (mean_length > 25))
            .withColumn("weak", (F.col("n_symbols") > 0.1 * words)
                        | ((F.col("n_dup_lines") > 0.4 * lines) & (F.col("n_dup_lines") >= 5))
                        | (mean_length > 15)))


def host_rates(flags: DataFrame, deviations: float) -> DataFrame:
    """host, n_docs, n_failed, rate (shrunk), limit: one row per host, null included.

    Failures are those of the weak and severe rules; base failures reject by
    themselves and say nothing about the host's pages that stay. Beta(a, b) prior
    by moments over the hosts' raw rates: m and v are their document-weighted mean
    and variance, a + b = m(1 - m)/v - 1. ``limit`` is the prior's mean plus
    ``deviations`` of its standard deviation: a host is bad if its shrunk rate is
    above it. With one host, or hosts that all agree, the variance is 0, every rate
    is m and no host is bad.
    """
    hosts = stored(flags.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum((F.col("severe") | F.col("weak")).cast("long")).alias("n_failed")),
        "hosts")
    raw = F.col("n_failed") / F.col("n_docs")
    m, second = hosts.agg(F.sum("n_failed") / F.sum("n_docs"),
                          F.sum(F.col("n_docs") * raw * raw) / F.sum("n_docs")).first()
    m = m or 0.0
    v = max((second or 0.0) - m * m, 0.0)
    strength = max(m * (1 - m) / v - 1, 1.0) if v > 1e-12 else 1e9
    limit = m + max(deviations * (m * (1 - m) / (strength + 1)) ** 0.5, 1e-6)
    return hosts.withColumn("rate", (F.col("n_failed") + F.lit(strength * m))
                            / (F.col("n_docs") + F.lit(strength))).withColumn("limit", F.lit(limit))


def quality_verdicts(docs: DataFrame, deviations: float = 0.5) -> DataFrame:
    """r1, r2, doc_id, the counts, base_failed, host, host_rate, by_host, kept per row
    of ``docs``.

    A document goes if it fails the base rule or a severe rule, or a weak rule
    on a host whose shrunk failure rate lies ``deviations`` standard deviations of
    the prior above all hosts' mean. ``by_host`` marks the documents whose host
    decided: those that fail a weak rule alone. A document that fails no rule
    stays, whatever its host. Null text counts as empty (no words: base_failed); a
    null source is a host of its own; repeated rows give repeated results; an
    empty table gives no rows. Extra columns are ignored.
    """
    flags = stored(rule_flags(text_counts(docs)), "quality")
    hosts = host_rates(flags, deviations).select(F.col("host").alias("h"), F.col("rate").alias("host_rate"), "limit")
    joined = flags.join(hosts, flags["host"].eqNullSafe(hosts["h"]))
    by_host = ~F.col("base_failed") & ~F.col("severe") & F.col("weak")
    bad = F.col("severe") | (F.col("weak") & (F.col("host_rate") > F.col("limit")))
    return joined.select(
        "r1", "r2", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "host", "host_rate", by_host.alias("by_host"), (~F.col("base_failed") & ~bad).alias("kept"))


def passing(docs: DataFrame, deviations: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the verdicts keep, with all their columns."""
    kept = quality_verdicts(docs, deviations).filter("kept").select(
        F.col("r1").alias("__r1"), F.col("r2").alias("__r2")).distinct()
    r1, r2 = row_key("doc_id", "source", "text")
    return (docs.withColumn("__r1", r1).withColumn("__r2", r2)
            .join(stored(kept, "passing"), ["__r1", "__r2"], "left_semi").drop("__r1", "__r2"))
