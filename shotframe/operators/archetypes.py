"""Unsupervised archetypes.

Input is the entity-season fingerprint (one row per entity and season, so
it grows with the number of entities, not with events).  Scaling and PCA come
from one aggregate of means and covariances, K-Means from sums per cluster
(``kmeans.py``); only model parameters (means, a 6x6 covariance, k centroids)
reach the driver, and projections are column expressions.  Cluster ids are
arbitrary; a component's sign is fixed by its largest loading; names come from
a rule on the cluster profile, not from ids.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import K_RANGE, SEED
from ..sources.files import rows_to_table
from . import kmeans as KM
from .trend import cumulative

# The archetype names, in the reference's cluster-id order.
ARCHETYPE_NAMES = ["Modern Versatile Scorer", "Rim-Dominant Big", "Floor-Spacing Specialist",
                   "High-Volume Perimeter", "Mid-Range Specialist"]

# Our naming rule (the reference names clusters by id): the share signature
# each name is read off.  The first name has none: it goes to the cluster
# that no signature claims.
VERSATILE_NAME = ARCHETYPE_NAMES[0]
ARCHETYPE_SIGNATURES = [
    (ARCHETYPE_NAMES[1], ["rim_share", "paint_share"]),
    (ARCHETYPE_NAMES[2], ["lc3_share", "rc3_share"]),
    (ARCHETYPE_NAMES[3], ["atb3_share"]),
    (ARCHETYPE_NAMES[4], ["mid_share"]),
]


def assemble(df: DataFrame, features, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def standardise(df: DataFrame, vec: str = "features", out: str = "scaled"):
    """Mean 0, sample sd 1 per slot.  Returns (model, transformed)."""
    m = StandardScaler(inputCol=vec, outputCol=out, withMean=True, withStd=True).fit(df)
    return m, m.transform(df)


@dataclass
class PcaModel:
    """Means and deviations of the features, and the components of their correlations, largest first."""

    features: list[str]
    mean: np.ndarray
    sd: np.ndarray
    loadings: np.ndarray        # feature x component
    explained: np.ndarray       # share of the variance per component

    @property
    def components(self) -> list[str]:
        return [f"PC{n}" for n in range(1, self.loadings.shape[1] + 1)]


def pca_fit(df: DataFrame, features: Iterable[str], k: int) -> PcaModel:
    """C1 + C2: means, deviations and covariances in one aggregate, components of the standardised features.

    A component's sign is that of its loading of largest size (the first of
    equals).  A feature without variance has loadings of 0.
    """
    features = list(features)
    d = len(features)
    pairs = [(i, j) for i in range(d) for j in range(i)]
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
                 *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(features)],
                 *[F.covar_samp(features[i], features[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(d)])
    sd = np.array([row[f"s{i}"] or 0.0 for i in range(d)])
    live = sd > 1e-15
    corr = np.diag(live.astype(float))
    for i, j in pairs:
        if live[i] and live[j]:
            corr[i, j] = corr[j, i] = row[f"c{i}_{j}"] / (sd[i] * sd[j])
    values, vectors = np.linalg.eigh(corr)
    order = np.argsort(-values, kind="stable")
    values, vectors = np.maximum(values[order], 0), vectors[:, order]
    top = np.abs(vectors).round(9).argmax(axis=0)
    signs = np.sign(vectors[top, np.arange(d)])
    return PcaModel(features, mean, np.where(live, sd, 0), (vectors * np.where(signs == 0, 1, signs))[:, :k],
                    (values / max(values.sum(), 1e-300))[:k])


def pca_project(df: DataFrame, model: PcaModel, out: str = "pca_features") -> DataFrame:
    """The components as columns ``PC1..`` and as the vector ``out``; plain column arithmetic."""
    weights = np.where(model.sd[:, None] > 0, model.loadings / np.where(model.sd > 0, model.sd, 1)[:, None], 0)
    parts = {}
    for name, w in zip(model.components, weights.T):
        parts[name] = sum(((F.col(c) - F.lit(float(m))) * F.lit(float(x)) for c, m, x in zip(model.features, model.mean, w)), F.lit(0.0))
    return df.withColumns(parts).withColumn(out, array_to_vector(F.array(*model.components)))


def explained_variance(spark: SparkSession, model: PcaModel) -> DataFrame:
    """C3 + W5: (component, explained_variance, cumulative)."""
    schema = T.StructType([T.StructField("component", T.IntegerType()),
                           T.StructField("explained_variance", T.DoubleType())])
    t = rows_to_table(spark, [(i + 1, float(v)) for i, v in enumerate(model.explained)], schema)
    return cumulative(t, "component", "explained_variance").orderBy("component")


def loadings(spark: SparkSession, model: PcaModel) -> DataFrame:
    """C4: feature x component loadings (PC1..PCk); bounded by the number of features."""
    schema = T.StructType([T.StructField("feature", T.StringType()),
                           *(T.StructField(c, T.DoubleType()) for c in model.components)])
    return rows_to_table(spark, [(f, *map(float, row)) for f, row in zip(model.features, model.loadings)], schema)


def k_sweep(points: DataFrame, columns: Iterable[str], fits: dict[int, KM.Clusters], ks=K_RANGE) -> DataFrame:
    """Silhouette (squared Euclidean, exact), training cost and the passes taken for each k."""
    chosen = {k: fits[k] for k in ks}
    scores = KM.silhouettes(points, columns, chosen)
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("silhouette", T.DoubleType()),
                           T.StructField("training_cost", T.DoubleType()), T.StructField("rounds", T.IntegerType()),
                           T.StructField("converged", T.BooleanType())])
    return rows_to_table(points.sparkSession, [(k, scores[k], f.cost, f.rounds, f.converged) for k, f in sorted(chosen.items())], schema)


def fit_clusters(points: DataFrame, columns: Iterable[str], ks: Iterable[int], seed: int = SEED) -> dict[int, KM.Clusters]:
    """C5 + C6: K-Means to its fixed point for every k, all k in the same passes."""
    return KM.fit_all(points, columns, ks, seed)


def assign(points: DataFrame, columns: Iterable[str], fit: KM.Clusters, out: str = "cluster") -> DataFrame:
    """Every point with its nearest centre."""
    return points.withColumn(out, KM.nearest(columns, fit.centres))


def assignment_table(assigned: DataFrame, keys, features, cluster: str = "cluster") -> DataFrame:
    """C9 + P15: keys, cluster, PC1, PC2 and the shares."""
    return assigned.select(*keys, cluster, "PC1", "PC2", *features)


def name_clusters(profile: DataFrame, cluster: str = "cluster",
                  signatures=ARCHETYPE_SIGNATURES, fallback: str = VERSATILE_NAME) -> DataFrame:
    """Names read off the cluster profile.

    Each signature's score is the sum of its shares, z-scored across
    clusters; (signature, cluster) pairs are taken greedily by score so
    each name goes to the cluster that shows it most, each cluster gets at
    most one name, and clusters left over are ``fallback`` (numbered when
    there are several).  The profile has k rows, so this runs on the driver
    over model-sized data and returns a k-row table for a broadcast join.
    """
    rows = profile.collect()
    ids = [r[cluster] for r in rows]
    scores = {}
    for name, cols in signatures:
        vals = [sum(float(r[c]) for c in cols) for r in rows]
        mean = sum(vals) / len(vals)
        sd = (sum((v - mean) ** 2 for v in vals) / max(len(vals) - 1, 1)) ** 0.5 or 1.0
        for cid, v in zip(ids, vals):
            scores[(name, cid)] = (v - mean) / sd
    names, used = {}, set()
    for (name, cid), _ in sorted(scores.items(), key=lambda kv: (-kv[1], kv[0][1], kv[0][0])):
        if name in used or cid in names:
            continue
        names[cid] = name
        used.add(name)
    left = [c for c in sorted(ids) if c not in names]
    for i, cid in enumerate(left):
        names[cid] = fallback if len(left) == 1 else f"{fallback} {i + 1}"
    schema = T.StructType([T.StructField(cluster, T.IntegerType()),
                           T.StructField("archetype", T.StringType())])
    return profile.sparkSession.createDataFrame([(int(c), names[c]) for c in sorted(ids)], schema)


def archetype_shift(era_table: DataFrame, names: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Era table with names (J2, broadcast of k rows), sorted by change,
    with the signed change text and the label height (P21)."""
    from ..functions.text import signed
    return (era_table.join(F.broadcast(names), cluster, "left")
            .withColumns({"delta_text": signed("delta_pct"),
                          "label_at": F.greatest("pre_pct", "post_pct")})
            .orderBy(F.desc("delta_pct"), cluster))
