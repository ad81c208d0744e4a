"""Each row with a value of the next row in the order of an id, by ranges of the id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, whole_row

#: Fine ranges lie inside coarse ones; a range holds about this many bytes.
COARSE = 64
RANGE_BYTES = 16 << 20
MOST_FINE = 1024


def _tree(x: Column, bounds: list, low: int = 0) -> Column:
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(x >= F.lit(bounds[mid]), _tree(x, bounds[mid + 1:], low + mid + 1)).otherwise(
        _tree(x, bounds[:mid], low))


#: Carries a range beside a row's own columns while columns are derived for it.
_RANGE = "__range_of_row__"


def with_next(rows: DataFrame, id_col: str, text_col: str, out_col: str,
              derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``derive(rows)`` with ``out_col``: a struct of the next row's columns by ascending id; the first row's after the last.

    ``derive`` adds columns row by row, once for every row; the first rows of
    the ranges are found without it.  Ids come in ranges whose bounds are
    approximate quantiles over all rows.  Each range is a window; where a range
    ends, the first row of the next one that has rows follows.  Rows that share
    an id follow each other in the order of their texts; null ids come first.
    Other columns may have any name; one named ``out_col`` is replaced.
    """
    names = derive(rows.limit(0)).columns
    facts = rows.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("bytes"),
                     F.percentile_approx(F.col(id_col), [k / COARSE for k in range(1, COARSE)], 10_000).alias("at")).first()
    coarse = sorted(set(facts["at"] or []))
    fine = max(1, min(MOST_FINE, -(-facts["bytes"] // (COARSE * RANGE_BYTES))))

    def carried(df: DataFrame) -> DataFrame:
        own = df.select(whole_row(df.columns).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        return own.withColumn("coarse", F.when(F.col("id").isNull(), -1).otherwise(_tree(F.col("id"), coarse)))

    inner = cut(carried(rows.select(id_col, text_col)).groupBy("coarse").agg(F.percentile_approx(
        "id", [k / fine for k in range(1, fine)], 10_000).alias("at"))) if fine > 1 else None

    def in_ranges(df: DataFrame) -> DataFrame:
        out = carried(df)
        if inner is None:
            return out.withColumn("fine", F.lit(0))
        return out.join(inner, "coarse").withColumn("fine", F.size(F.filter("at", lambda b: b <= F.col("id")))).drop("at")

    order = Window.partitionBy("coarse", "fine").orderBy(F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first())
    led = in_ranges(derive(rows)).withColumn("next", F.lead("row").over(order))
    firsts = cut(in_ranges(rows).groupBy("coarse", "fine").agg(F.min_by("row", F.struct("id", "text")).alias("row")))
    heads = derive(firsts.select(F.struct("coarse", "fine").alias(_RANGE), "row.*")).select(
        f"{_RANGE}.*", whole_row(names).alias("first"))
    # one row for each range, as many as the ranges: the first of the next range, and of the first after the last
    ranges = Window.partitionBy(F.lit(0)).orderBy("coarse", "fine")
    turn = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = heads.select("coarse", "fine", F.coalesce(F.lead("first").over(ranges), F.first("first").over(turn)).alias("head"))
    return led.join(follow, ["coarse", "fine"], "left").select(
        *[F.col("row").getField(n).alias(n) for n in names if n != out_col], F.coalesce("next", "head").alias(out_col))
