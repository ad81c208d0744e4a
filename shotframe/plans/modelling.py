"""Entry 2: shot-make model job (features, L1 path, classifier comparison).

    shots -> ACTION_GROUP -> repeatable 80/20 split -> feature stages fitted on
    train only -> checkpointed (features, label) -> packed matrix -> 6 L1 fits
    one after the other with warm starts, beside 2 classifiers on the cached rows

The split is a hash of the row key (``key_split``), so train and test are
the same rows whatever the cluster size; pass ``split_keys=None`` for
Spark's ``randomSplit``.  Features are checkpointed under the shared folder;
the path reads them once, into its matrix, and the classifiers persist them
MEMORY_AND_DISK, as every optimiser step re-reads them.  A lost executor
re-reads its partitions of the checkpoint.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import add_action_group
from ..operators import features as FE
from ..operators import models as M
from ..operators import newton as NW
from ..operators.select import drawn_split, key_draw, random_split
from ..schema import (CATEGORICAL_FEATURES, DEFAULT_COLUMNS, HEADLINE_PENALTY, LASSO_PENALTIES,
                      NUMERIC_FEATURES, SEED, ShotColumns)
from ..session import ensure_checkpoint_dir


@dataclass
class ModelRun:
    train: DataFrame
    test: DataFrame
    names: list
    feature_model: object
    label: str
    penalties: list = field(default_factory=lambda: list(LASSO_PENALTIES))
    _matrix: object = None
    _models: list | None = None
    _comparison_rows: list | None = None
    _fitted: dict = field(default_factory=dict)
    _lock: threading.Lock = field(default_factory=threading.Lock)
    _cmp_lock: threading.Lock = field(default_factory=threading.Lock)

    def cache(self) -> None:
        """Both parts in memory, materialised before concurrent fits read them."""
        for part in (self.train, self.test):
            part.persist(StorageLevel.MEMORY_AND_DISK).count()

    def matrix(self) -> NW.Matrix:
        """The training rows packed once for all fits and certificates."""
        with self._lock:
            if self._matrix is None:
                self._matrix = NW.pack(self.train, "features", self.label, len(self.names))
            return self._matrix

    def models(self) -> list:
        """(penalty, coefficients, intercept) along the path."""
        matrix = self.matrix() if len(self.names) <= NW.MOST_SLOTS else None
        with self._lock:
            if self._models is None:
                self._models = M.path_models(self.train, len(self.names), self.label, self.penalties, matrix=matrix)
            return self._models

    def path(self) -> DataFrame:
        return M.path_table(self.train.sparkSession, self.models(), self.names)

    def path_certificate(self) -> DataFrame:
        return M.path_certificate(self.train.sparkSession, self.matrix(), self.models())

    def comparison(self) -> DataFrame:
        spark = self.train.sparkSession
        with self._cmp_lock:
            if self._comparison_rows is None:
                self.cache()
                df = M.compare_classifiers(self.train, self.test, self.label, fitted=self._fitted)
                self._comparison_rows = (df.schema, [tuple(r) for r in df.collect()])
        schema, rows = self._comparison_rows
        return spark.createDataFrame(rows, schema)

    def svm_certificate(self) -> DataFrame:
        self.comparison()
        fit = self._fitted["LinearSVC"]
        return M.svm_certificate(self.train.sparkSession, self.matrix(), fit.coefficients.toArray(), fit.intercept,
                                 fit.getRegParam())

    def run_all(self) -> None:
        """Fit the path and the classifiers concurrently (their jobs overlap)."""
        from concurrent.futures import ThreadPoolExecutor

        from pyspark import inheritable_thread_target
        own = inheritable_thread_target
        with ThreadPoolExecutor(max_workers=2) as pool:
            for f in [pool.submit(own(self.path)), pool.submit(own(self.comparison))]:
                f.result()

    def release(self) -> None:
        if self._matrix is not None:
            self._matrix.release()
        self.train.unpersist()
        self.test.unpersist()


#: Rows of a partition of the model input, and the fewest partitions.
PARTITION_ROWS, FEWEST_PARTITIONS = 500_000, 4


def partitions_for(rows: int) -> int:
    """Partitions of a model input of so many rows: a task's share stays the same, however large the input."""
    return max(FEWEST_PARTITIONS, -(-rows // PARTITION_ROWS))


def spread(df: DataFrame, partitions: int | None = None, keys=None) -> DataFrame:
    """The model input in a given number of partitions, by ``keys`` if there are any; as it is by default.

    Every optimiser step scans the cached rows, so an input of one large file
    would run each step on one core: the caller, who knows the input and the
    cluster, names a number.  With keys the rows are hash-partitioned by them
    (deterministic without the sort that a round-robin repartition needs).
    """
    if partitions is None:
        return df
    return df.repartition(partitions, *keys) if keys else df.repartition(partitions)


def prepare(shots: DataFrame, cols: ShotColumns = DEFAULT_COLUMNS, split_keys=None,
            weights=(0.8, 0.2), seed: int = SEED, numeric=NUMERIC_FEATURES,
            categorical=CATEGORICAL_FEATURES, partitions: int | None = None,
            reliable: bool = True) -> ModelRun:
    """Split, fit feature stages on train, checkpoint (features, label) of both parts.

    The model input (feature and label columns, and the draw of the keys) is
    computed from the fact table once and held MEMORY_AND_DISK while the
    indexer is fitted and both parts are transformed.

    With ``reliable`` (default) the (features, label) tables are written as
    a checkpoint under the shared folder before anything reads them: the ~400
    optimiser passes of a path then have a lineage that ends at that small
    checkpoint, so a lost executor re-reads its partitions instead of
    re-scanning and re-joining the fact table.
    """
    FE.check_no_leakage(list(numeric) + list(categorical))
    keys = list(split_keys or [])
    raw_cats = [c for c in categorical if c != cols.action_group]
    need = list(dict.fromkeys(list(numeric) + raw_cats + [cols.action, cols.made_int] + keys))
    held = list(dict.fromkeys(list(numeric) + list(categorical) + [cols.made_int]))
    draw = "draw"
    while draw in held:
        draw += "_"
    rows = add_action_group(shots.select(*need), cols)
    rows = rows.select(*held, key_draw(keys, seed).alias(draw)) if keys else rows.select(*held)
    base = spread(rows, partitions, [draw] if keys else None).persist(StorageLevel.MEMORY_AND_DISK)
    if keys:
        train, test = drawn_split(base, F.col(draw), weights)
    else:
        train, test = random_split(base, weights, seed)
    fm = FE.fit_features(train, numeric, categorical)
    tr = fm.transform(train).select("features", cols.made_int)
    te = fm.transform(test).select("features", cols.made_int)
    names = FE.slot_names(fm)
    if reliable:
        ensure_checkpoint_dir(shots.sparkSession)
        tr, te = tr.checkpoint(eager=True), te.checkpoint(eager=True)
    run = ModelRun(tr, te, names, fm, cols.made_int)
    if not reliable:
        run.cache()
    base.unpersist()
    return run


def headline(run: ModelRun, penalty: float = HEADLINE_PENALTY) -> DataFrame:
    return M.headline_coefficients(run.path(), penalty)


_MEMO: dict = {}
_MEMO_LOCK = threading.Lock()


def memo_run(spark: SparkSession, key: str, build) -> ModelRun:
    """One model run per (application, key): many queries share the fits."""
    k = (spark.sparkContext.applicationId, key)
    with _MEMO_LOCK:
        if k not in _MEMO:
            _MEMO[k] = build()
        return _MEMO[k]
