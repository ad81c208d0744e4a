"""Filters, samples and splits.

All are narrow transformations (no shuffle) and reach the Parquet scan as
pushed filters or partition filters when placed over a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exclude_value(df: DataFrame, col: str, value, keep_nulls: bool = False) -> DataFrame:
    """drop rows whose ``col`` equals ``value``.

    Plain ``col != value`` also drops NULLs (three-valued logic); that is the
    reference behaviour and the default.  ``keep_nulls=True`` keeps them.
    """
    cond = F.col(col) != value
    if keep_nulls:
        cond = cond | F.col(col).isNull()
    return df.filter(cond)


def min_support(df: DataFrame, col: str, minimum) -> DataFrame:
    """keep rows with ``col >= minimum`` (a HAVING when ``col`` is an aggregate)."""
    return df.filter(F.col(col) >= minimum)


def since(df: DataFrame, col: str, start) -> DataFrame:
    """``col >= start``; on a partition column this prunes directories."""
    return df.filter(F.col(col) >= start)


def bernoulli_sample(df: DataFrame, fraction: float | None, seed: int = 42) -> DataFrame:
    """row sample without replacement; ``None`` means the whole table.

    The draw depends on the partition layout; use ``key_sample`` for a draw
    that repeats across cluster sizes.
    """
    if fraction is None:
        return df
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


#: Bits of a key's draw, a whole number below 2**52 (13 hex digits).
DRAW_BITS = 52


def key_draw(key_cols, seed: int = 42):
    """A whole number in [0, 2**52) drawn from the row key and ``seed``.

    The first 13 hex digits of the MD5 of the seed and the key's values as
    text, null as ``-``: built-in functions that other engines have under the
    same names, so a sample or a split can be repeated and checked outside
    Spark.  It depends on nothing else, neither partitioning nor file layout
    nor executors.  Keys should be whole numbers, text, dates or flags; a
    double's text differs between engines.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in key_cols])
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def draw_bound(share: float) -> int:
    """The draws below this number are ``share`` of all."""
    return round(share * (1 << DRAW_BITS))


def key_sample(df: DataFrame, key_cols, fraction: float, seed: int = 42) -> DataFrame:
    """F4 (repeatable): keep a row when the draw of its key falls into the first ``fraction``."""
    return df.filter(key_draw(key_cols, seed) < draw_bound(fraction))


def random_split(df: DataFrame, weights, seed: int = 42):
    """Spark's ``randomSplit`` (depends on partition layout)."""
    return df.randomSplit(list(weights), seed=seed)


def key_split(df: DataFrame, key_cols, weights, seed: int = 42):
    """F5 (repeatable): split by a hash of the row key.

    Each row lands in exactly one part whatever the cluster size, so a test
    split is the same on 8 cores and on 1000 executors.  No shuffle.
    """
    return drawn_split(df, key_draw(key_cols, seed), weights)


def drawn_split(df: DataFrame, draw: Column, weights):
    """F5 of rows whose draw (``key_draw``) is known already."""
    total, acc, bounds = float(sum(weights)), 0.0, [0]
    for w in weights:
        acc += w / total
        bounds.append(draw_bound(acc))
    bounds[-1] = 1 << DRAW_BITS
    return [df.filter((draw >= lo) & (draw < hi)) for lo, hi in zip(bounds, bounds[1:])]


def regex_exclude(df: DataFrame, col: str, patterns) -> DataFrame:
    """drop rows whose ``col`` matches any pattern, case-insensitive."""
    rx = "(?i)" + "|".join(patterns)
    return df.filter(~F.col(col).rlike(rx))


def magnitude_flag(df: DataFrame, col: str, threshold: float, out: str = "kept") -> DataFrame:
    """flag ``abs(col) >= threshold`` (keep both sides; filter on ``out``)."""
    return df.withColumn(out, F.abs(F.col(col)) >= threshold)


def nonzero(df: DataFrame, col: str) -> DataFrame:
    """F8: ``col != 0``."""
    return df.filter(F.col(col) != 0)


def window_flag(col: str, lo, hi):
    """``lo <= col <= hi`` as a boolean column."""
    return F.col(col).between(lo, hi)


def point_value(df: DataFrame, key: str, at, value: str, out: str | None = None) -> DataFrame:
    """the value of ``value`` where ``key == at`` as a one-row table."""
    return df.agg(F.max(F.when(F.col(key) == at, F.col(value))).alias(out or f"{value}_at"))
