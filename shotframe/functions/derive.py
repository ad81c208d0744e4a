"""Scalar column functions (P1-P12): all built-in expressions, no UDFs.

Every function returns a ``Column`` so callers can put many of them into one
``withColumns`` / ``select`` (one Project node, one codegen stage).
ANSI mode is on in Spark 4, so parsing and division use the ``try_``
variants: a bad date or a zero denominator gives NULL instead of failing
the job.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ACTION_DEFAULT, ACTION_RULES, DEFAULT_COLUMNS, THREE_PT_TYPE, ShotColumns


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bool_to_int(c) -> Column:
    """Boolean -> 0/1 (NULL stays NULL)."""
    return _c(c).cast("int")


def parse_date(c, fmt: str = "MM-dd-yyyy") -> Column:
    """Text -> date; unparsable or empty text gives NULL (never raises)."""
    return F.try_to_date(_c(c), fmt)


def clock_seconds(mins, secs) -> Column:
    """Minutes and seconds left -> seconds left."""
    return _c(mins) * 60 + _c(secs)


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (a NULL condition gives 0)."""
    return F.when(cond, 1).otherwise(0)


def value_map(c, mapping: dict, default) -> Column:
    """P5: category -> value with a default (NULL category gets the default)."""
    items = list(mapping.items())
    expr = F.when(_c(c) == items[0][0], F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(_c(c) == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def clutch_flag(quarter, secs_remaining, min_quarter: int = 4, max_secs: int = 120) -> Column:
    """Final ``max_secs`` of quarter ``min_quarter`` or any later period."""
    return flag((_c(quarter) >= min_quarter) & (_c(secs_remaining) <= max_secs))


def keyword_bucket(c, rules=ACTION_RULES, default: str = ACTION_DEFAULT) -> Column:
    """Lower-case substring rules, first match wins; NULL -> default.

    ``rules`` is data: a list of (bucket, [keywords]).  The chained CASE keeps
    the rule order, which is what makes "Turnaround Hook Shot" a Hook.
    """
    lc = F.lower(_c(c))
    expr = None
    for bucket, words in rules:
        cond = reduce(lambda a, b: a | b, [lc.contains(w) for w in words])
        expr = F.when(cond, bucket) if expr is None else expr.when(cond, bucket)
    return expr.otherwise(default)


def era_label(season, cut_points, labels) -> Column:
    """Period label from ascending cut points.

    ``era_label(s, [2015], ["pre", "post"])`` gives ``post`` for s >= 2015.
    n cut points need n + 1 labels.  A NULL season gets the first label,
    as ``when(s >= cut, ...).otherwise(...)`` does.
    """
    if len(labels) != len(cut_points) + 1:
        raise ValueError("need len(cut_points) + 1 labels")
    expr = F.lit(labels[0])
    for cut, lab in zip(cut_points, labels[1:]):
        expr = F.when(_c(season) >= cut, lab).otherwise(expr)
    return expr


def row_sum(cols) -> Column:
    """Row-wise sum of columns, left to right."""
    return reduce(add, [_c(x) for x in cols])


def share(part, total) -> Column:
    """Part / total as double, NULL when total is 0 or NULL."""
    return F.try_divide(_c(part).cast("double"), _c(total))


def derive_shots(df: DataFrame, cols: ShotColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Add the seven processed columns in one projection.

    SHOT_MADE_INT, GAME_DATE_PARSED, SECS_REMAINING, IS_3PT, SHOT_VALUE,
    IS_CLUTCH, EXPECTED_PTS.  EXPECTED_PTS is the *actual* points scored on
    the attempt (value x made); its mean per group is points per attempt.
    """
    made_int = bool_to_int(cols.made)
    secs = clock_seconds(cols.mins_left, cols.secs_left)
    is3 = F.col(cols.shot_type) == THREE_PT_TYPE
    shot_value = value_map(cols.shot_type, {THREE_PT_TYPE: 3}, 2)
    return df.withColumns({
        "SHOT_MADE_INT": made_int,
        "GAME_DATE_PARSED": parse_date(cols.game_date, cols.date_format),
        "SECS_REMAINING": secs,
        "IS_3PT": flag(is3),
        "SHOT_VALUE": shot_value,
        "IS_CLUTCH": clutch_flag(cols.quarter, secs),
        "EXPECTED_PTS": shot_value * made_int,
    })


def add_action_group(df: DataFrame, cols: ShotColumns = DEFAULT_COLUMNS,
                     rules=ACTION_RULES) -> DataFrame:
    """P8 as a DataFrame step: ACTION_TYPE -> ACTION_GROUP."""
    return df.withColumn(cols.action_group, keyword_bucket(cols.action, rules))
