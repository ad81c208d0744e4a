"""Penalty-path summaries (A10-A12, W9-W11, L1, L2) on a long path table.

The input is (param, feature, value) — e.g. (regParam, feature,
coefficient) from ``models.penalty_path`` — with one row per penalty and
slot, so every table here is bounded by penalties x slots.  Column names
are parameters, so the same operators summarise any long table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import feature_category, replace_all
from . import cells as CE
from .select import magnitude_flag, nonzero, regex_exclude


def screening_path(df: DataFrame, label: str, numeric: Iterable[str], categorical: Iterable[str], penalties: Iterable[float],
                   digits: int = 9) -> DataFrame:
    """The one-feature-at-a-time L1 path (regParam, feature, coefficient).

    With standardised features that do not overlap, the L1 path has a closed
    form: a feature's correlation with the 0/1 label, shrunk by the penalty.
    It screens features before a joint fit.  Numeric features take one
    aggregate of the facts, the levels of all categorical ones (named as the
    one-hot slots are) the additive cells of another; a feature or a label
    without variance gets 0.  Penalties go with the feature table, one row
    each per feature.
    """
    numeric, categorical = list(numeric), list(categorical)
    y = F.col(CE.quoted(label)).cast("int")

    def correlation(c):  # F.corr divides by zero where a column is constant
        x = F.col(CE.quoted(c)).cast("double")
        x, z = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y.cast("double"))
        return F.coalesce(F.try_divide(F.covar_samp(x, z), F.stddev_samp(x) * F.stddev_samp(z)), F.lit(0.0))
    one = df.agg(*[correlation(c).alias(f"c{i}") for i, c in enumerate(numeric)])
    parts = ", ".join(f"{CE.literal(c)}, c{i}" for i, c in enumerate(numeric))
    found = one.select(F.expr(f"stack({len(numeric)}, {parts}) AS (feature, c)"))
    cells = CE.value_cells(df.where(y.isNotNull()), categorical, {"made": y})
    whole = Window.partitionBy("column_name")  # a column's levels: a bounded domain
    levels = CE.values_of_cells(cells, categorical, ["made"]).withColumns(
        {"all_n": F.sum(CE.N).over(whole), "all_made": F.sum("made").over(whole)}).where(F.col("level").isNotNull())
    n, m, a, b = (F.col(c).cast("double") for c in (CE.N, "made", "all_n", "all_made"))
    c = F.coalesce(F.try_divide(a * m - n * b, F.sqrt(n * (a - n)) * F.sqrt(b * (a - b))), F.lit(0.0))
    found = found.unionByName(levels.select(F.concat("column_name", F.lit("_ohe_"), "level").alias("feature"), c.alias("c")))
    shrunk = F.greatest(F.abs("c") - F.col("regParam"), F.lit(0.0))
    return (found.withColumn("c", F.round("c", digits))
            .withColumn("regParam", F.explode(F.array(*[F.lit(float(p)) for p in penalties])))
            .select("regParam", "feature", (F.round(F.sign("c") * shrunk, digits) + 0.0).alias("coefficient")))  # no -0.0


def active_features(path: DataFrame, param: str = "regParam", value: str = "coefficient", feature: str = "feature") -> DataFrame:
    """F8: the features with a non-zero value at each param."""
    return nonzero(path, value).select(param, feature)


def active_counts(path: DataFrame, param: str = "regParam", value: str = "coefficient",
                  feature: str = "feature") -> DataFrame:
    """A10: non-zero values per param (a param with none gives 0), param descending."""
    return (path.groupBy(param)
            .agg(F.count_if(F.col(value) != 0).alias("n_active"),
                 F.count(F.col(feature)).alias("n_features"))
            .orderBy(F.desc(param)))


def path_wide(path: DataFrame, names, param: str = "regParam", value: str = "coefficient",
              feature: str = "feature") -> DataFrame:
    """One row per param, one column per feature (missing -> 0).

    A conditional aggregate per known feature name: one exchange, no
    distinct-values job.
    """
    return (path.groupBy(param)
            .agg(*[F.coalesce(F.max(F.when(F.col(feature) == n, F.col(value))), F.lit(0.0)).alias(n)
                   for n in names])
            .orderBy(F.desc(param)))


def peak_magnitude(path: DataFrame, value: str = "coefficient",
                   feature: str = "feature") -> DataFrame:
    """Max |value| per feature over the path."""
    return path.groupBy(feature).agg(F.max(F.abs(F.col(value))).alias("peak_abs"))


def top_features(path: DataFrame, k: int = 8, value: str = "coefficient",
                 feature: str = "feature") -> DataFrame:
    """The k features with the largest peak magnitude (name as tie-break)."""
    return (peak_magnitude(path, value, feature)
            .orderBy(F.desc("peak_abs"), F.asc(feature)).limit(k))


def entry_order(path: DataFrame, param: str = "regParam", value: str = "coefficient",
                feature: str = "feature") -> DataFrame:
    """The largest param at which each feature is non-zero, and its entry rank.

    Features that are never active get NULL and no rank.  Rank is dense:
    features entering at the same penalty share it.
    """
    first = path.groupBy(feature).agg(
        F.max(F.when(F.col(value) != 0, F.col(param))).alias("entry_param"))
    w = Window.orderBy(F.desc("entry_param"))  # one row per feature (bounded)
    return first.withColumn(
        "entry_rank", F.when(F.col("entry_param").isNotNull(), F.dense_rank().over(w)))


def monotone_steps(counts: DataFrame, param: str = "regParam",
                   count: str = "n_active") -> DataFrame:
    """Change in active count from the previous (stronger) penalty."""
    w = Window.orderBy(F.desc(param))  # one row per penalty (bounded)
    prev = F.lag(count).over(w)
    return counts.withColumns({"change": F.col(count) - prev,
                               "non_decreasing": F.coalesce(F.col(count) >= prev, F.lit(True))})


def path_summary(path: DataFrame, k: int = 8, **cols) -> DataFrame:
    """L1 composite: per feature its peak magnitude, entry penalty, entry rank
    and whether it is among the k largest."""
    feature = cols.get("feature", "feature")
    peaks = peak_magnitude(path, cols.get("value", "coefficient"), feature)
    top = top_features(path, k, cols.get("value", "coefficient"), feature) \
        .select(feature, F.lit(True).alias("in_top"))
    return (peaks.join(entry_order(path, **cols), feature)
            .join(F.broadcast(top), feature, "left")  # k rows
            .withColumn("in_top", F.coalesce("in_top", F.lit(False)))
            .orderBy(F.desc("peak_abs"), feature))


def coefficient_table(coefs: DataFrame, exclude=("Back Court",), threshold: float = 0.02,
                      feature: str = "feature", value: str = "coefficient") -> DataFrame:
    """L2: report table of headline coefficients.

    Drops features matching ``exclude`` (case-insensitive), flags
    ``|coef| >= threshold`` as kept (the dropped ones stay listed with
    kept = false), adds the report label and the feature category, sorted by
    coefficient ascending.
    """
    kept = magnitude_flag(regex_exclude(coefs, feature, exclude), value, threshold)
    return (kept.select(feature, value, "kept", feature_category(feature).alias("category"),
                        replace_all(feature).alias("label"))
            .orderBy(value, feature))
