"""Exact order statistics and quantiles of any number of distinct values (Q14).

Distributed selection: each wanted rank starts with the range of all values.
A round sketches the values inside each range (``percentile_approx``, bounded
memory), takes two data values a little below and above the wanted rank, and
counts rows below and at them.  The counts are exact, so the range narrows to
a sliver, by a factor of a thousand or more a round, or the value is found.  No task ever holds
a table of values, nothing is sorted or shuffled, and a value that half of the
rows share ends the search at once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Size of the sketches: their ranks are off by up to one part in so many.
ACCURACY = 10_000


@dataclass
class Range:
    """Values strictly between ``low`` and ``high`` (None: no bound); ``below`` rows come before, ``n`` lie inside."""

    low: float | None
    high: float | None
    below: int
    n: int

    def holds(self, x: Column) -> Column:
        inside = x.isNotNull()
        if self.low is not None:
            inside &= x > F.lit(self.low)
        if self.high is not None:
            inside &= x < F.lit(self.high)
        return inside


def _sketched(df: DataFrame, x: Column, searched: dict[int, Range], accuracy: int) -> Row:
    """Two data values around each rank's place in its range."""
    found = []
    for rank, r in searched.items():
        place, slack = (rank - r.below + 0.5) / r.n, 2 / accuracy
        around = [min(1.0, max(0.0, place - slack)), min(1.0, max(0.0, place + slack))]
        found.append(F.percentile_approx(F.when(r.holds(x), x), around, accuracy).alias(f"r{rank}"))
    return df.agg(*found).first()


def order_statistics(df: DataFrame, column: str, ranks, n: int, accuracy: int = ACCURACY) -> dict[int, float]:
    """The values (as doubles) at the given 0-based ranks among the ``n`` non-null values of ``column``.

    Not-a-number is the largest value, as in Spark's order.
    """
    x = F.col("`" + column.replace("`", "``") + "`").cast("double")
    searched = {r: Range(None, None, 0, n) for r in sorted(set(ranks))}
    found: dict[int, float] = {}
    while searched:
        split = {rank: sorted(set(v)) for rank, v in zip(searched, _sketched(df, x, searched, accuracy))}
        values = sorted({v for vs in split.values() for v in vs}, key=lambda v: (math.isnan(v), v))
        counts = df.agg(*[F.count_if(test).alias(f"{side}{i}") for i, v in enumerate(values)
                          for side, test in (("b", x < F.lit(v)), ("t", x <= F.lit(v)))]).first()
        at = {repr(v): (counts[f"b{i}"], counts[f"t{i}"]) for i, v in enumerate(values)}
        left = {}
        for rank, r in searched.items():
            low, high, below, above = r.low, r.high, r.below, r.below + r.n
            for v in split[rank]:
                before, through = at[repr(v)]
                if before <= rank < through:
                    found[rank] = v
                elif through <= rank and through >= below:
                    low, below = v, through
                elif rank < before and before <= above:
                    high, above = v, before
            if rank not in found:
                left[rank] = Range(low, high, below, above - below)
        searched = left
    return found


def exact_quantiles(df: DataFrame, column: str, probs, accuracy: int = ACCURACY) -> tuple[list[float | None], Row]:
    """Quantiles with linear interpolation between neighbouring ranks, and the row ``n, min, max``.

    All are None for a column without values.  ``df`` is read once per round
    and count (about ``2 * (1 + log(n) / log(accuracy / 4))`` times), one
    column of it; a result of a costly plan should be written first.
    """
    c = F.col("`" + column.replace("`", "``") + "`")
    whole = df.agg(F.count(c).alias("n"), F.min(c).alias("min"), F.max(c).alias("max")).first()
    if not whole.n:
        return [None] * len(probs), whole
    places = [(whole.n - 1) * p for p in probs]
    ranks = {f(h) for h in places for f in (math.floor, math.ceil)}
    values = order_statistics(df, column, ranks, whole.n, accuracy)
    out = []
    for h in places:
        low, high, part = values[math.floor(h)], values[math.ceil(h)], h - math.floor(h)
        out.append(low if low == high else low * (1 - part) + high * part)
    return out, whole
