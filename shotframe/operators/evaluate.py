"""Classifier evaluation on DataFrames (M11 exact AUC, prefix sums).

Exact ROC-AUC by rank sum with mid-ranks for ties:
    AUC = sum_s pos(s) * (neg(< s) + neg(s) / 2) / (P * N)
First the rows collapse to one row per distinct score (partial aggregate),
then ``neg(< s)`` is a prefix sum over scores.  The prefix sum is two-level
so that no task ever holds the whole score list: distinct scores are cut
into equi-depth buckets (``QuantileDiscretizer``), each bucket's total
comes from a small aggregate (one row per bucket), the bucket offsets are a
running sum over those few rows, and the in-bucket prefix is a window
partitioned by bucket.  The number of buckets follows the number of distinct
scores, so that a bucket holds about ``ROWS_PER_BUCKET`` of them.  Numerators stay integers (decimal(38,0)) until the
final division, so the result does not depend on summation order.
"""

from __future__ import annotations

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 200_000


def prefix_sum_exclusive(df: DataFrame, order: str, value: str, out: str = "prefix",
                         buckets: int | None = None) -> DataFrame:
    """Sum of ``value`` over all rows with a smaller ``order`` (ties excluded).

    ``order`` must be unique per row and not NULL (aggregate and filter first).  Work is spread over
    ``buckets`` tasks, by default one for each ``ROWS_PER_BUCKET`` rows;
    only ``buckets`` small rows are combined globally.
    """
    if buckets is None:
        buckets = max(8, -(-df.count() // ROWS_PER_BUCKET))
    d = df.withColumn("_ord_d", F.col(order).cast("double"))
    qd = QuantileDiscretizer(numBuckets=buckets, inputCol="_ord_d", outputCol="_bucket",
                             relativeError=0.001, handleInvalid="keep")
    b = qd.fit(d).transform(d)
    totals = b.groupBy("_bucket").agg(F.sum(value).alias("_btot"))
    # One row per bucket: a running sum over at most ``buckets`` rows.
    offsets = totals.withColumn(
        "_boff", F.coalesce(F.sum("_btot").over(
            Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return (b.join(offsets.select("_bucket", "_boff"), "_bucket")
            .withColumn(out, F.col("_boff") + F.col("_in"))
            .drop("_bucket", "_boff", "_in", "_ord_d"))


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    lab = F.col(label).cast("int")
    return df.groupBy(score).agg(F.count_if(lab == 1).cast("long").alias("pos"),
                                 F.count_if(lab == 0).cast("long").alias("neg"))


def auc_rank(df: DataFrame, label: str, score: str, digits: int | None = 10,
             buckets: int | None = None) -> DataFrame:
    """Exact ROC-AUC with ties counted one half; one row (auc, n_pos, n_neg).

    Rows without a score or a label have no rank and count in neither class.

    The per-score counts (one row per distinct score) are checkpointed to
    the shared folder: the bucket fit and both prefix-sum branches then read
    that small table, and the fact table is scanned once.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    ranked = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    g = score_counts(ranked, label, score).checkpoint(eager=True)
    g = prefix_sum_exclusive(g, score, "neg", out="neg_below", buckets=buckets)
    dec = "decimal(38,0)"
    num = F.sum(F.col("pos").cast(dec) * F.col("neg_below").cast(dec) * 2
                + F.col("pos").cast(dec) * F.col("neg").cast(dec))
    out = g.agg(num.alias("_num"), F.sum("pos").cast("long").alias("n_pos"),
                F.sum("neg").cast("long").alias("n_neg"))
    den = (F.col("n_pos").cast(dec) * F.col("n_neg").cast(dec) * 2).cast("double")
    auc = F.try_divide(F.col("_num").cast("double"), den)
    return out.select((F.round(auc, digits) if digits is not None else auc).alias("auc"),
                      "n_pos", "n_neg")
