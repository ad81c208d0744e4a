"""Trends over ordered periods.

These run on per-period aggregates (one row per season, or per entity and
season), never on the fact table.  With ``partition`` given, windows are
partitioned by the entity, so each series is one task's work and the
series are spread over the cluster; the single global series (no entity)
has one row per period — 21 in the reference — and is bounded by the
number of periods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _window(period: str, partition=None):
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return w.orderBy(period)


def change_from_previous(df: DataFrame, period: str, value: str, partition=None,
                         out: str = "yoy_change", digits: int | None = 1) -> DataFrame:
    """Value minus the value of the previous period (first is NULL).

    "Previous" is the previous row in period order, so a gap year compares
    with the last period present, as a row-wise diff does.
    """
    w = _window(period, partition)
    d = F.col(value) - F.lag(value).over(w)
    return df.withColumns({
        "prev_" + period: F.lag(period).over(w),
        out: F.round(d, digits) if digits is not None else d,
    })


def steepest_change(df_with_change: DataFrame, period: str, change: str = "yoy_change",
                    partition=None) -> DataFrame:
    """The row with the largest change (earliest period on ties)."""
    if partition:
        w = Window.partitionBy(*partition).orderBy(F.desc(change), F.asc(period))
        return (df_with_change.filter(F.col(change).isNotNull())
                .withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r"))
    return (df_with_change.filter(F.col(change).isNotNull())
            .orderBy(F.desc(change), F.asc(period)).limit(1))


def is_steepest(period: str, change: str = "yoy_change", partition=None):
    """W2 as a flag: whether a row has the largest change (earliest period on ties)."""
    w = (Window.partitionBy(*partition) if partition else Window.partitionBy()).orderBy(
        F.desc_nulls_last(change), F.asc(period))
    return (F.row_number().over(w) == 1) & F.col(change).isNotNull()


def endpoint_change(df: DataFrame, period: str, value: str, partition=None,
                    digits: int = 1, ratio_digits: int = 3) -> DataFrame:
    """W3 + W4: first and last value by period, their difference and ratio."""
    g = df.groupBy(*partition) if partition else df
    out = g.agg(F.min(period).alias("first_period"), F.min_by(value, period).alias("first_value"),
                F.max(period).alias("last_period"), F.max_by(value, period).alias("last_value"))
    return out.withColumns({
        "change": F.round(F.col("last_value") - F.col("first_value"), digits),
        "ratio": F.round(F.try_divide(F.col("last_value"), F.col("first_value")), ratio_digits),
    })


def cumulative(df: DataFrame, order: str, value: str, out: str = "cumulative",
               partition=None) -> DataFrame:
    """Running sum in ``order`` (e.g. cumulative explained variance)."""
    w = _window(order, partition).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))
