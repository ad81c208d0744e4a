"""Entry 3: entity archetypes (fingerprint -> scale -> PCA -> K-Means -> names).

The fingerprint aggregate is the only step that touches the fact table
(one scan, one shuffle on (entity, season) after map-side partial counts);
everything after it runs on one row per entity-season.  The fingerprint is
written once as a reliable checkpoint under the shared folder
(``spark.checkpoint.dir``) before the scaler: lineage is cut there, so a
lost executor during the passes of PCA and K-Means re-reads the small
checkpoint instead of re-aggregating the fact table.  The sweep's values of k
and the chosen one are fitted together, a pass for all.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators import aggregate as A
from ..operators import archetypes as C
from ..operators import kmeans as KM
from ..schema import CHOSEN_K, DEFAULT_COLUMNS, K_RANGE, N_PCA, SEED, ShotColumns
from ..session import ensure_checkpoint_dir


@dataclass
class ArchetypeRun:
    points: DataFrame          # fingerprint + PC1.., pca_features (cached)
    assigned: DataFrame        # points + cluster
    pca_model: C.PcaModel
    km_model: KM.Clusters
    fits: dict
    shares: list
    keys: list
    ks: list
    _sweep_rows: list | None = None

    def loadings(self) -> DataFrame:
        return C.loadings(self.points.sparkSession, self.pca_model)

    def explained(self) -> DataFrame:
        return C.explained_variance(self.points.sparkSession, self.pca_model)

    def sweep(self) -> DataFrame:
        if self._sweep_rows is None:
            df = C.k_sweep(self.points, self.pca_model.components, self.fits, self.ks)
            self._sweep_rows = (df.schema, [tuple(r) for r in df.collect()])
        schema, rows = self._sweep_rows
        return self.points.sparkSession.createDataFrame(rows, schema)

    def certificate(self) -> DataFrame:
        return KM.certificate(self.assigned, self.pca_model.components, self.km_model.centres)

    def profile(self) -> DataFrame:
        return A.mean_profile(self.assigned, "cluster", self.shares, 3)

    def by_era(self) -> DataFrame:
        return A.group_comparison(self.assigned, "cluster", "ERA", ("pre", "post"))

    def names(self) -> DataFrame:
        return C.name_clusters(self.profile())

    def shift(self) -> DataFrame:
        return C.archetype_shift(self.by_era(), self.names())

    def assignments(self) -> DataFrame:
        return C.assignment_table(self.assigned, self.keys, self.shares)

    def centroids(self) -> DataFrame:
        return A.centroids(self.assignments(), "cluster", ["PC1", "PC2"])

    def release(self) -> None:
        self.points.unpersist()


def run_archetypes(fingerprint: DataFrame, cols: ShotColumns = DEFAULT_COLUMNS,
                   k: int = CHOSEN_K, ks=K_RANGE, n_pca: int = N_PCA, seed: int = SEED) -> ArchetypeRun:
    """Fit the archetype models on an entity-season fingerprint.

    The fingerprint is checkpointed (aggregate computed once, lineage cut).
    The clusters depend on the points and ``seed`` alone, so they are the same
    for any layout and on any cluster size.
    """
    shares = A.share_columns(cols)
    keys = [cols.entity, cols.entity_name, cols.season]
    ensure_checkpoint_dir(fingerprint.sparkSession)
    fp = fingerprint.checkpoint(eager=True)
    pca_model = C.pca_fit(fp, shares, n_pca)
    points = C.pca_project(fp, pca_model).persist(StorageLevel.MEMORY_AND_DISK)
    fits = C.fit_clusters(points, pca_model.components, {k, *ks}, seed)
    assigned = C.assign(points, pca_model.components, fits[k])
    return ArchetypeRun(points, assigned, pca_model, fits[k], fits, shares,
                        [cols.entity_name, cols.season, "ERA"], list(ks))


_MEMO: dict = {}
_LOCK = threading.Lock()


def memo_archetypes(spark: SparkSession, key: str, build) -> ArchetypeRun:
    k = (spark.sparkContext.applicationId, key)
    with _LOCK:
        if k not in _MEMO:
            _MEMO[k] = build()
        return _MEMO[k]
