"""Aggregations and pivots.

Every aggregate here is a plain ``groupBy().agg()`` with built-in functions,
so Spark plans a partial (map-side) aggregate before the shuffle and a final
one after it: what crosses the network is one row per (task, group), not one
row per event.  That also makes a hot key (one zone or one player holding a
third of the rows) harmless — the hot group is pre-reduced in every task.

Pivots are written as conditional sums over a fixed value list: one
exchange, where ``groupBy().pivot(values).count()`` plans two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import era_label, row_sum, share
from ..schema import DEFAULT_COLUMNS, ShotColumns
from .select import min_support


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """round(num / den * 100, digits), NULL-safe."""
    return F.round(F.try_divide(num.cast("double"), den) * 100, digits)


# ---------------------------------------------------------------- A1, A2, Q9
def efficiency_by(df: DataFrame, key: str, made: str = "SHOT_MADE_INT",
                  points: str | None = "EXPECTED_PTS") -> DataFrame:
    """A1: attempts, FG % and points per attempt per ``key``.

    fg_pct = round(avg(made) * 100, 1), pts_per_attempt = round(avg(points), 3),
    sorted by points per attempt (or attempts) descending, key as tie-break.
    """
    aggs = [F.count(F.lit(1)).alias("attempts"),
            F.round(F.avg(F.col(made)) * 100, 1).alias("fg_pct")]
    if points:
        aggs.append(F.round(F.avg(F.col(points)), 3).alias("pts_per_attempt"))
        order = [F.desc("pts_per_attempt"), F.asc(key)]
    else:
        order = [F.desc("attempts"), F.asc(key)]
    return df.groupBy(key).agg(*aggs).orderBy(*order)


def rate_by_period(df: DataFrame, period: str = "SEASON_1", flag_col: str = "IS_3PT",
                   made: str = "SHOT_MADE_INT") -> DataFrame:
    """A2: total, flagged count, flagged rate % and overall FG % per period."""
    return (df.groupBy(period)
            .agg(F.count(F.lit(1)).alias("total_attempts"),
                 F.sum(F.col(flag_col)).cast("long").alias("three_pt_attempts"),
                 F.round(F.sum(F.col(flag_col)) / F.count(F.lit(1)) * 100, 1)
                 .alias("three_pt_rate_pct"),
                 F.round(F.avg(F.col(made)) * 100, 1).alias("overall_fg_pct"))
            .orderBy(period))


def zone_period_cells(df: DataFrame, zone: str = "BASIC_ZONE", period: str = "SEASON_1",
                      flag_col: str = "IS_3PT", made: str = "SHOT_MADE_INT",
                      points: str = "EXPECTED_PTS") -> DataFrame:
    """One pass for both A1 and A2: additive sums per (zone, period) cell.

    The cell table has (#zones x #periods) rows — 126 for the reference —
    and holds counts and sums (never averages), so both report tables are
    exact re-aggregations of it.  One scan and one shuffle replace two.
    """
    return (df.groupBy(zone, period)
            .agg(F.count(F.lit(1)).alias("attempts"),
                 F.sum(F.col(made)).cast("long").alias("made"),
                 F.count(F.col(made)).alias("made_n"),
                 F.sum(F.col(flag_col)).cast("long").alias("flagged"),
                 F.sum(F.col(points)).cast("long").alias("points"),
                 F.count(F.col(points)).alias("points_n")))


def efficiency_from_cells(cells: DataFrame, zone: str = "BASIC_ZONE") -> DataFrame:
    """A1 from the cell table (same numbers as ``efficiency_by``)."""
    return (cells.groupBy(zone)
            .agg(F.sum("attempts").cast("long").alias("attempts"),
                 F.round(F.try_divide(F.sum("made"), F.sum("made_n")) * 100, 1).alias("fg_pct"),
                 F.round(F.try_divide(F.sum("points"), F.sum("points_n")), 3)
                 .alias("pts_per_attempt"))
            .orderBy(F.desc("pts_per_attempt"), F.asc(zone)))


def rate_from_cells(cells: DataFrame, period: str = "SEASON_1") -> DataFrame:
    """A2 from the cell table (same numbers as ``rate_by_period``)."""
    return (cells.groupBy(period)
            .agg(F.sum("attempts").cast("long").alias("total_attempts"),
                 F.sum("flagged").cast("long").alias("three_pt_attempts"),
                 F.round(F.try_divide(F.sum("flagged"), F.sum("attempts")) * 100, 1)
                 .alias("three_pt_rate_pct"),
                 F.round(F.try_divide(F.sum("made"), F.sum("made_n")) * 100, 1)
                 .alias("overall_fg_pct"))
            .orderBy(period))


# ---------------------------------------------------------------- A3, A4
def pivot_counts(df: DataFrame, keys, col: str, values, names=None,
                 use_pivot: bool = False) -> DataFrame:
    """A3: rows per (keys) x fixed ``values`` of ``col``, missing cells 0.

    Default: ``count_if(col = v)`` per value — one aggregate, one exchange.
    ``use_pivot=True`` uses ``groupBy().pivot()`` (two exchanges) and fills
    only the pivot columns, so NULL keys stay NULL.
    """
    names = list(names or values)
    if use_pivot:
        out = df.groupBy(*keys).pivot(col, list(values)).count()
        out = out.withColumnsRenamed(dict(zip(values, names)))
        return out.fillna(0, subset=names)
    return df.groupBy(*keys).agg(
        *[F.count_if(F.col(col) == v).alias(n) for v, n in zip(values, names)])


def share_fingerprint(df: DataFrame, cols: ShotColumns = DEFAULT_COLUMNS,
                      keys=None, min_attempts: int | None = None) -> DataFrame:
    """A4: one row per (entity, name, season) with per-zone counts and shares.

    Columns: keys, ``<base>_cnt`` (bigint) for the fixed zones, total_attempts
    (sum of those counts only: rows in unlisted or NULL zones do not count),
    ``<base>_share`` (double) and ERA.  Groups below the minimum support are
    dropped after the aggregate (a HAVING).
    """
    keys = list(keys or [cols.entity, cols.entity_name, cols.season])
    zones = list(cols.zones.keys())
    bases = list(cols.zones.values())
    cnt = [b + "_cnt" for b in bases]
    minimum = cols.min_attempts if min_attempts is None else min_attempts
    counts = pivot_counts(df, keys, cols.zone, zones, cnt)
    out = min_support(counts.withColumn("total_attempts", row_sum(cnt)), "total_attempts", minimum)
    out = out.withColumns({b + "_share": share(b + "_cnt", "total_attempts") for b in bases})
    return out.withColumn("ERA", era_label(cols.season, [cols.era_split], ["pre", "post"]))


def share_columns(cols: ShotColumns = DEFAULT_COLUMNS):
    return [b + "_share" for b in cols.zones.values()]


# ---------------------------------------------------------------- A5-A9
def mean_profile(df: DataFrame, group: str, features, digits: int | None = 3,
                 count_name: str = "n") -> DataFrame:
    """A5: n and (rounded) mean of each feature per group, sorted by group."""
    def m(c):
        return F.round(F.avg(c), digits) if digits is not None else F.avg(c)
    return (df.groupBy(group)
            .agg(F.count(F.lit(1)).alias(count_name), *[m(c).alias(c) for c in features])
            .orderBy(group))


def group_comparison(df: DataFrame, group: str, label: str, levels=("pre", "post"),
                     digits: int = 1) -> DataFrame:
    """A6 (+A7, J1): counts of ``group`` per ``label`` level, % of that level, change.

    Level totals come from a window sum over the small (groups x levels)
    result, so nothing is collected to the driver and a level with no rows
    gives NULL percentages instead of a KeyError.  delta is the difference
    of the two *rounded* percentages (as published).
    """
    lv = list(levels)
    counts = df.groupBy(group).agg(*[F.count_if(F.col(label) == v).alias(v) for v in lv])
    whole = Window.partitionBy()  # the input is one row per group (bounded)
    out = counts.withColumns({f"{v}_pct": pct(F.col(v), F.sum(v).over(whole), digits)
                              for v in lv})
    if len(lv) == 2:
        out = out.withColumn("delta_pct", F.round(F.col(f"{lv[1]}_pct") - F.col(f"{lv[0]}_pct"),
                                                  digits))
    return out.orderBy(group)


def group_totals(df: DataFrame, label: str) -> DataFrame:
    """Rows per label value."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def global_means(df: DataFrame, features, digits: int | None = None) -> DataFrame:
    """One-row table of feature means."""
    def m(c):
        return F.round(F.avg(c), digits) if digits is not None else F.avg(c)
    return df.agg(*[m(c).alias(c) for c in features])


def centroids(df: DataFrame, group: str, coords, digits: int | None = None) -> DataFrame:
    """N and mean coordinates per group."""
    return mean_profile(df, group, coords, digits, count_name="n")


def relative_to(table: DataFrame, key: str, value: str, base, digits: int = 3) -> DataFrame:
    """Each row's ``value`` as a ratio to the row whose ``key`` is ``base``,
    and as percent more/less.  ``table`` is a small result table (one row per
    key); the base value is a window max over it.
    """
    b = F.max(F.when(F.col(key) == base, F.col(value))).over(Window.partitionBy())
    ratio = F.try_divide(F.col(value), b)
    return table.select(key, value, F.round(ratio, digits).alias("ratio_to_base"),
                        F.round((ratio - 1) * 100, 1).alias("pct_vs_base"))


# ---------------------------------------------------------------- A13, A14
def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Tn, fp, fn, tp in one aggregate (zeros when a cell is empty)."""
    lab = F.col(label).cast("int")
    pre = F.col(prediction).cast("int")
    return df.agg(F.count_if((lab == 0) & (pre == 0)).alias("tn"),
                  F.count_if((lab == 0) & (pre == 1)).alias("fp"),
                  F.count_if((lab == 1) & (pre == 0)).alias("fn"),
                  F.count_if((lab == 1) & (pre == 1)).alias("tp"))


def _zdiv(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def binary_metrics(confusion: DataFrame, digits: int | None = 10) -> DataFrame:
    """A14 + M12: precision, recall, accuracy, weighted F1 from the four counts.

    Zero denominators give 0 (as the reference's precision/recall do).
    Weighted F1 = sum over both classes of (support / n) * F1 of that class,
    which is what MLlib's ``f1`` metric computes.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    prec1, rec1 = _zdiv(tp, tp + fp), _zdiv(tp, tp + fn)
    prec0, rec0 = _zdiv(tn, tn + fn), _zdiv(tn, tn + fp)
    f1_1 = _zdiv(2 * prec1 * rec1, prec1 + rec1)
    f1_0 = _zdiv(2 * prec0 * rec0, prec0 + rec0)
    wf1 = _zdiv((tp + fn) * f1_1 + (tn + fp) * f1_0, n)

    def r(c):
        return F.round(c, digits) if digits is not None else c
    return confusion.select(
        "tn", "fp", "fn", "tp",
        r(prec1).alias("precision"), r(rec1).alias("recall"),
        r(_zdiv(tp + tn, n)).alias("accuracy"), r(wf1).alias("f1_weighted"))


def majority_floor(df: DataFrame, label: str, digits: int | None = 10) -> DataFrame:
    """Accuracy of always predicting the larger class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    out = counts.agg(F.max("n").alias("majority_n"), F.sum("n").cast("long").alias("n"))
    acc = F.col("majority_n") / F.col("n")
    return out.withColumn("floor_accuracy", F.round(acc, digits) if digits is not None else acc)
