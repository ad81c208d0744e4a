"""Bounded, repeatable samples of labelled rows for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, label: str, key: Column, per_label: int) -> list[Row]:
    """About ``per_label`` rows of each label value, chosen by a hash of ``key``.

    One count per label, then one pass whose filter keeps the expected number;
    the hash order and the total bound make the sample repeatable and strict.
    """
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    if not counts:
        return []
    shares = F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, min(1.0, per_label / n))])
    draw = F.pmod(F.xxhash64(key, F.lit(7)), F.lit(2**40)) / F.lit(float(2**40))
    return (rows.where(F.col(label).isNotNull()).withColumn("_draw", draw)
            .where(F.col("_draw") < shares[F.col(label)]).orderBy("_draw")
            .limit(int(1.2 * per_label * len(counts)) + 1).drop("_draw").collect())
