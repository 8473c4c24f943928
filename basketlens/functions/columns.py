"""Column-level helpers: built-in expressions only, so they stay inside codegen."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.schemas import CATEGORY_SEPARATOR, TRAIN_FRACTION_TENTHS


def main_category(category_code: str | Column = "category_code") -> Column:
    """First element of a dotted category path ('a.b.c' -> 'a', 'a' -> 'a')."""
    return F.substring_index(_col(category_code), CATEGORY_SEPARATOR, 1)


def parse_event_time(c: str | Column) -> Column:
    """Text -> timestamp; unparseable text becomes NULL instead of failing the job."""
    return F.try_to_timestamp(_col(c))


def whole_seconds_between(start: str | Column, end: str | Column) -> Column:
    """end - start in seconds, each side truncated to a whole second first."""
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def ratio_2dp(numerator: str | Column, denominator: str | Column) -> Column:
    """round(n / d, 2), half up, of the exact ratio of two counts (n, d >= 0).

    floor((200 n + d) / 2d) / 100 is the half-up rounding of n/d itself; it is
    exact for counts below 2**45 and gives the same bits in any IEEE engine,
    unlike rounding an already rounded binary double.  NULL when d = 0.
    """
    n, d = _col(numerator).cast("bigint"), _col(denominator).cast("bigint")
    q = F.try_divide(n * 200 + d, F.nullif(d * 2, F.lit(0)))
    return (F.floor(q) / F.lit(100.0)).cast("double")


def in_train_split(key: str | Column = "user_session") -> Column:
    """Stable 80/20 split by a hash of the session key.

    Unlike ``randomSplit`` it does not depend on partitioning or on the plan
    feeding it, so train and test stay disjoint when a lost task is recomputed.
    """
    bucket = F.conv(F.substring(F.md5(_col(key)), 1, 4), 16, 10).cast("int") % 10
    return bucket < TRAIN_FRACTION_TENTHS


def sample_sessions_flag(key: str | Column, per_mille: int) -> Column:
    """Keep whole sessions: a key is in the sample iff its hash bucket < per_mille."""
    bucket = F.conv(F.substring(F.md5(_col(key)), 1, 4), 16, 10).cast("int") % 1000
    return bucket < per_mille


def probability_of(col: str | Column = "probability", index: int = 1) -> Column:
    """Element ``index`` of an ML probability vector, no Python UDF."""
    return vector_to_array(_col(col)).getItem(index)


def top_k_indices(prob_array: str | Column, k: int = 3) -> Column:
    """Indices of the k largest entries, largest first (ties: lower index first)."""
    arr = _col(prob_array)
    pairs = F.transform(arr, lambda x, i: F.struct((-x).alias("neg"), i.alias("idx")))
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda s: s["idx"])


def lookup_labels(indices: str | Column, labels: str | Column) -> Column:
    """Map each class index to its label; out-of-range -> 'unknown'."""
    lab = _col(labels)
    return F.transform(
        _col(indices),
        lambda i: F.coalesce(F.try_element_at(lab, (i + 1).cast("int")), F.lit("unknown")))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
