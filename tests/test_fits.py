"""Newton path, certificates, PCA and K-Means against brute force."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from shotframe.operators import archetypes as C
from shotframe.operators import kmeans as KM
from shotframe.operators import models as M
from shotframe.operators import newton as NW


def table(spark, x, y, parts=3):
    rows = [([float(v) for v in r], float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "a array<double>, y double").repartition(parts).select(array_to_vector("a").alias("features"), "y")


def logistic_rows(n, seed):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(3, 5, n), rng.normal(size=n), (rng.random(n) < 0.3).astype(float), rng.normal(size=n), np.full(n, 4.0)])
    x = np.column_stack([x, x[:, 2]])          # a copy of a slot, as one-hot levels make them
    z = 0.4 * (x[:, 0] - 3) - 1.2 * x[:, 1] + 1.5 * x[:, 2] - 0.5
    return x, (rng.random(n) < 1 / (1 + np.exp(-z))).astype(float)


def objective(x, y, w, b, l1):
    z = x @ w + b
    return np.mean(np.logaddexp(0, z) - y * z) + l1 * np.sum(np.abs(w) * x.std(axis=0, ddof=1))


def test_path_is_optimal_and_copies_share(spark):
    x, y = logistic_rows(900, 1)
    m = NW.pack(table(spark, x, y), "features", "y", x.shape[1])
    assert m.n == 900 and np.allclose(m.mean, x.mean(axis=0)) and np.allclose(m.sd, x.std(axis=0, ddof=1))
    fits = NW.l1_path(m, [0.5, 0.05, 0.005, 0.0005])
    assert not fits[0].scaled[:-1].any() and all(f.converged for f in fits)
    assert sum(f.passes for f in fits[1:]) <= 24
    rng = np.random.default_rng(0)
    for l1, f in zip([0.5, 0.05, 0.005, 0.0005], fits):
        w, b = m.raw(f.scaled)
        assert w[4] == 0 and abs(w[2] - w[5]) < 1e-9
        best = objective(x, y, w, b, l1)
        assert abs(best - f.objective) < 1e-12
        for _ in range(60):                     # no point around it is better
            assert objective(x, y, w + rng.normal(size=6) * 10.0 ** rng.uniform(-5, -1), b + rng.normal() * 1e-3, l1) >= best - 1e-12
    m.release()


def test_warm_start_takes_fewer_passes(spark):
    x, y = logistic_rows(900, 2)
    m = NW.pack(table(spark, x, y), "features", "y", x.shape[1])
    warm = NW.l1_path(m, [0.02, 0.018])[1]
    cold = NW.l1_logistic(m, 0.018)
    assert np.allclose(warm.scaled, cold.scaled, atol=1e-6) and warm.passes < cold.passes
    m.release()


def test_certificate_tells_an_optimum_from_another_point(spark):
    x, y = logistic_rows(600, 3)
    train = table(spark, x, y)
    m = NW.pack(train, "features", "y", x.shape[1])
    models = M.path_models(train, x.shape[1], "y", [0.01], matrix=m)
    p, w, b = models[0]
    off = w.copy()
    off[0] *= 1.01
    rows = M.path_certificate(spark, m, [(p, w, b), (p, off, b), (2 * p, w, b)]).collect()
    assert [r.optimal for r in rows] == [True, False, False]
    library = M._mllib_path(train, "y", [0.01], "features", 200, 1)[0]
    assert NW.l1_residuals(m, [library])[0] < 1e-3 and np.allclose(library[1], w, atol=1e-3)
    m.release()


def test_dual_bound_is_below_every_classifier(spark):
    x, y = logistic_rows(500, 4)
    m = NW.pack(table(spark, x, y), "features", "y", x.shape[1])
    rng = np.random.default_rng(1)
    side, sd = np.where(y > 0, 1.0, -1.0), x.std(axis=0, ddof=1)

    def primal(w, b):
        return np.mean(np.maximum(0, 1 - side * (x @ w + b))) + 0.005 * np.sum((w * sd) ** 2)

    from pyspark.ml.classification import LinearSVC
    fit = LinearSVC(featuresCol="features", labelCol="y", regParam=0.01, maxIter=200).fit(table(spark, x, y))
    w = fit.coefficients.toArray()
    assert abs(NW.hinge_objective(m, w, fit.intercept, 0.01) - primal(w, fit.intercept)) < 1e-12
    for start in (None, m.scaled(w, fit.intercept)):
        bound, _ = NW.hinge_dual_bound(m, 0.01, start)
        assert bound <= primal(w, fit.intercept) + 1e-12
        assert all(primal(w + rng.normal(size=6) * 0.1, fit.intercept + rng.normal() * 0.1) >= bound for _ in range(50))
    assert M.svm_certificate(spark, m, w, fit.intercept, 0.01).first().optimal
    assert not M.svm_certificate(spark, m, 3 * w, fit.intercept, 0.01).first().optimal
    m.release()


def test_pca_of_given_columns(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)) + 100
    x[:, 3] = 7.0
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double").repartition(3)
    model = C.pca_fit(df, list("abcd"), 3)
    z = (x[:, :3] - x[:, :3].mean(axis=0)) / x[:, :3].std(axis=0, ddof=1)
    values, vectors = np.linalg.eigh(np.cov(z, rowvar=False))
    assert np.allclose(model.explained, values[::-1] / 3) and not model.loadings[3].any()
    for i in range(3):
        assert model.loadings[np.abs(model.loadings[:, i]).argmax(), i] > 0
        assert np.allclose(np.abs(model.loadings[:3, i]), np.abs(vectors[:, 2 - i]))
    got = np.array(sorted((r.a, r.PC1, r.PC2, r.PC3) for r in C.pca_project(df, model).collect()))
    assert np.allclose(got[:, 1:], (z @ model.loadings[:3])[np.argsort(x[:, 0])])
    assert C.pca_fit(df.limit(1), list("ab"), 2).loadings.shape == (2, 2)


def blobs(n, seed):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(c, 0.6, (n, 2)) for c in ((0, 0), (5, 1), (1, 6))])


def test_fixed_points_and_silhouettes(spark):
    x = blobs(150, 6)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "PC1 double, PC2 double").repartition(4)
    fits = KM.fit_all(df, ["PC1", "PC2"], [2, 3, 5], seed=1)
    scores = KM.silhouettes(df, ["PC1", "PC2"], fits)
    vectors = df.withColumn("v", array_to_vector(F.array("PC1", "PC2")))
    for k, f in fits.items():
        own = ((x[:, None] - f.centres[None]) ** 2).sum(axis=2)
        assert f.converged and sorted(np.bincount(own.argmin(axis=1), minlength=k)) == sorted(f.sizes)
        assert np.allclose([x[own.argmin(axis=1) == c].mean(axis=0) for c in range(k)], f.centres)
        assert abs(own.min(axis=1).sum() - f.cost) < 1e-6
        assigned = C.assign(vectors, ["PC1", "PC2"], f)
        theirs = ClusteringEvaluator(featuresCol="v", predictionCol="cluster").evaluate(assigned)
        assert abs(scores[k] - theirs) < 1e-9
        assert tuple(KM.certificate(assigned, ["PC1", "PC2"], f.centres).first()) == (450, 0, True)
    assert sorted(fits[3].sizes) == [150, 150, 150] and max(scores, key=scores.get) == 3
    moved = KM.certificate(C.assign(vectors, ["PC1", "PC2"], fits[3]), ["PC1", "PC2"], fits[3].centres + 0.5).first()
    assert not moved.centres_hold


@pytest.mark.parametrize("values, k", [([1.0, 1.0, 1.0], 2), ([1.0], 3), ([0.0, 0.0, 9.0, 9.0, 9.0], 2)])
def test_few_and_equal_points(spark, values, k):
    df = spark.createDataFrame([(v,) for v in values], "PC1 double")
    f = KM.fit_all(df, ["PC1"], [k], seed=0)[k]
    assert f.converged and f.cost == 0 and sum(f.sizes) == len(values)
    assert -1 <= KM.silhouettes(df, ["PC1"], {k: f})[k] <= 1


def test_layout_makes_no_difference(spark):
    x = blobs(200, 7)
    out = []
    for parts in (1, 7):
        df = spark.createDataFrame([tuple(map(float, r)) for r in x], "PC1 double, PC2 double").repartition(parts)
        out.append(KM.fit_all(df, ["PC1", "PC2"], [4], seed=3)[4].centres)
    assert np.allclose(out[0], out[1], atol=1e-12)


def test_no_points_and_no_rows(spark):
    with pytest.raises(ValueError, match="no points"):
        KM.fit_all(spark.createDataFrame([], "PC1 double"), ["PC1"], [2], seed=0)
    with pytest.raises(ValueError, match="no rows"):
        NW.pack(table(spark, np.ones((2, 1)), [0, 1]).limit(0), "features", "y", 1)


def test_screening_path_by_hand(spark):
    from shotframe.operators import path as PT
    rng = np.random.default_rng(8)
    n = 400
    x, kind = rng.normal(size=n), rng.choice(["a", "b", "c"], n)
    y = (x + (kind == "a") + rng.normal(size=n) > 0.5).astype(int)
    rows = [(float(a), 1.0, str(k), int(b)) for a, k, b in zip(x, kind, y)] + [(0.0, 1.0, None, 1)]
    df = spark.createDataFrame(rows, "x double, flat double, kind string, y int").repartition(3)
    got = {(r.regParam, r.feature): r.coefficient for r in PT.screening_path(df, "y", ["x", "flat"], ["kind"], [0.2, 0.01]).collect()}
    full = np.append(y, 1)
    want = {"x": np.corrcoef(np.append(x, 0), full)[0, 1], "flat": 0.0}
    want |= {f"kind_ohe_{k}": np.corrcoef(np.append(kind == k, False), full)[0, 1] for k in "abc"}
    for p in (0.2, 0.01):
        for f, c in want.items():
            assert got[p, f] == pytest.approx(np.sign(c) * max(abs(c) - p, 0), abs=1e-8)
    assert len(got) == 10
    active = {(r.regParam, r.feature) for r in PT.active_features(spark.createDataFrame(
        [(p, f, c) for (p, f), c in got.items()], "regParam double, feature string, coefficient double")).collect()}
    assert active == {k for k, c in got.items() if c}


def test_a_fit_takes_over_the_last_pass_of_its_start(spark, monkeypatch):
    x, y = logistic_rows(900, 9)
    m = NW.pack(table(spark, x, y), "features", "y", x.shape[1])
    taken, one = [], NW.log_loss
    monkeypatch.setattr(NW, "log_loss", lambda matrix, at: taken.append(tuple(at)) or one(matrix, at))
    fits = NW.l1_path(m, [0.05, 0.005])
    assert len(set(taken)) == len(taken) == sum(f.passes for f in fits) and all(f.converged for f in fits)
    m.release()


def test_blocks_are_small_and_give_back_every_number(spark):
    from shotframe.operators import blocks as B
    rng = np.random.default_rng(10)
    x = np.column_stack([rng.normal(size=5000), np.eye(30)[rng.integers(0, 30, 5000)]])
    x[:3, 0] = [np.inf, -0.0, 5e-324]

    def marks(values):
        return float((np.ascontiguousarray(values).view(np.uint64) % 65521).sum())

    m = B.packed(table(spark, x, x[:, 0], 2), vector_to_array("features"), F.col("y"), 31)
    bits = B.added_up(m, 31, lambda a, b: np.array([marks(a[:, 0]), marks(b), a[:, 1:].sum(), len(b)]), 4)
    want = marks(x[:, 0])
    assert list(bits) == [want, want, 5000, 5000]
    assert m.agg(F.sum(F.length("x"))).first()[0] < x.nbytes / 4
    m.unpersist()


def test_sums_are_added_up_in_tasks_of_their_own_number(spark):
    """A vector of sums is not written out for every shuffle partition of the session."""
    from shotframe.operators import blocks as B
    m = NW.pack(table(spark, np.ones((50, 2)), np.ones(50)), "features", "y", 2)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.sparkContext.setJobGroup("sums", "sums")
        assert list(B.added_up(m.blocks, 2, lambda x, y: np.full(600, float(len(y))), 600)) == [50.0] * 600
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("sums")
        tracker = spark.sparkContext.statusTracker()
        tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
        assert tasks and max(tasks) <= 4
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    m.release()
