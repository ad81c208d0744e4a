"""Model and clustering outputs against brute-force computations on the
sf0.01 fixture (these queries have no SQL oracle)."""

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array

from conftest import SF_ORACLE
from shotframe.operators.evaluate import auc_rank
from shotframe.plans.ml_queries import archetype_run, model_run
from shotframe.plans.queries import SHARES


def test_pca_matches_numpy_eigendecomposition(spark):
    run = archetype_run(spark, SF_ORACLE)
    x = np.array([[r[c] for c in SHARES] for r in run.points.select(*SHARES).collect()])
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    vals, vecs = np.linalg.eigh(np.cov(z, rowvar=False))
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    ours = np.array([[r[f"PC{j}"] for j in range(1, 6)] for r in run.loadings().collect()])
    for j in range(5):                              # sign of a component is arbitrary
        assert min(np.abs(ours[:, j] - vecs[:, j]).max(), np.abs(ours[:, j] + vecs[:, j]).max()) < 1e-6
    ev = [r.explained_variance for r in run.explained().collect()]
    assert np.allclose(ev, vals[:5] / vals.sum(), atol=1e-9)


def test_kmeans_assigns_nearest_centre(spark):
    run = archetype_run(spark, SF_ORACLE)
    centres = np.array(run.km_model.clusterCenters())
    rows = run.assigned.select(vector_to_array("pca_features").alias("p"), "cluster").collect()
    pts = np.array([r.p for r in rows])
    got = np.array([r.cluster for r in rows])
    d = ((pts[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    assert (d[np.arange(len(got)), got] <= d.min(axis=1) + 1e-9).all()
    sizes = {r.cluster: r.n for r in run.profile().collect()}
    assert sizes == {c: int((got == c).sum()) for c in set(got.tolist())}


def test_model_auc_exact_equals_rank_sum(spark):
    from pyspark.ml.classification import LogisticRegression
    run = model_run(spark, SF_ORACLE)
    preds = LogisticRegression(featuresCol="features", labelCol=run.label, regParam=0.01,
                               maxIter=50).fit(run.train).transform(run.test)
    mllib = BinaryClassificationEvaluator(labelCol=run.label, rawPredictionCol="rawPrediction",
                                          numBins=0).evaluate(preds)
    scored = preds.select(run.label, vector_to_array("probability")[1].alias("score"))
    ours = auc_rank(scored, run.label, "score", digits=None).first().auc
    assert abs(mllib - ours) < 1e-9


def _fista_l1_logistic(X, y, sd, lam, iters=4000):
    """Brute-force optimum of mean log-loss + lam * sum |w_j| sd_j (the
    objective MLlib minimises with standardization on)."""
    keep = sd > 0
    Xs = X[:, keep] / sd[keep]
    n, d = Xs.shape
    L = 0.25 * (np.linalg.norm(Xs, 2) ** 2 + n) / n
    v = np.zeros(d + 1)
    x, t = v.copy(), 1.0
    for _ in range(iters):
        z = Xs @ v[:-1] + v[-1]
        p = 1 / (1 + np.exp(-z))
        u = v - np.append(Xs.T @ (p - y), np.sum(p - y)) / n / L
        xn = u.copy()
        xn[:-1] = np.sign(u[:-1]) * np.maximum(np.abs(u[:-1]) - lam / L, 0)
        tn = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, x, t = xn + (t - 1) / tn * (xn - x), xn, tn
    w = np.zeros(X.shape[1])
    w[keep] = x[:-1] / sd[keep]
    return w, x[-1]


def test_lasso_path_reaches_the_l1_optimum(spark):
    from shotframe.plans.queries import queries
    run = model_run(spark, SF_ORACLE)
    rows = run.train.collect()
    X = np.array([r.features.toArray() for r in rows])
    y = np.array([r[run.label] for r in rows], dtype=float)
    sd = X.std(axis=0, ddof=1)

    def objective(w, b, lam):
        z = X @ w + b
        return np.mean(np.logaddexp(0, z) - y * z) + lam * np.sum(np.abs(w) * sd)

    def best_intercept(w):
        b, zw = 0.0, X @ w
        for _ in range(50):                                  # 1-D Newton on the intercept
            p = 1 / (1 + np.exp(-(zw + b)))
            b -= np.sum(p - y) / max(np.sum(p * (1 - p)), 1e-12)
        return b

    path = queries()["lasso_path"](spark, SF_ORACLE).collect()
    for lam in (0.05, 0.001):
        coef = {r.feature: r.coefficient for r in path if abs(r.regParam - lam) < 1e-12}
        w = np.array([coef[n] for n in run.names])
        wb, bb = _fista_l1_logistic(X, y, sd, lam)
        assert objective(w, best_intercept(w), lam) <= objective(wb, bb, lam) + 1e-6
        assert int((w != 0).sum()) == int((np.abs(wb) > 1e-8).sum())


def test_linear_svc_near_its_optimum(spark):
    """MLlib's LinearSVC (maxIter 50, as published) against a smoothed-hinge
    accelerated-gradient solution of the same objective: mean hinge loss +
    lam/2 * sum (w_j sd_j)^2.  The 50-iteration fit stops ~0.1 % above it."""
    from pyspark.ml.classification import LinearSVC
    run = model_run(spark, SF_ORACLE)
    rows = run.train.collect()
    X = np.array([r.features.toArray() for r in rows])
    y = np.where(np.array([r[run.label] for r in rows]) > 0, 1.0, -1.0)
    sd = X.std(axis=0, ddof=1)
    lam, mu = 0.01, 1e-3

    def objective(w, b):
        return np.mean(np.maximum(0, 1 - y * (X @ w + b))) + 0.5 * lam * np.sum((w * sd) ** 2)

    keep = sd > 0
    Xs = X[:, keep] / sd[keep]
    n, d = Xs.shape
    L = (np.linalg.norm(Xs, 2) ** 2 + n) / (n * mu) + lam
    v = np.zeros(d + 1)
    x, t = v.copy(), 1.0
    for _ in range(8000):
        m = 1 - y * (Xs @ v[:-1] + v[-1])
        g = np.where(m <= 0, 0.0, np.where(m >= mu, 1.0, m / mu))       # Huber-smoothed hinge
        grad = np.append(-(Xs.T @ (g * y)) / n + lam * v[:-1], -np.sum(g * y) / n)
        xn = v - grad / L
        tn = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, x, t = xn + (t - 1) / tn * (xn - x), xn, tn
    wb = np.zeros(X.shape[1])
    wb[keep] = x[:-1] / sd[keep]
    fit = LinearSVC(featuresCol="features", labelCol=run.label, regParam=lam, maxIter=50).fit(run.train)
    ours = objective(fit.coefficients.toArray(), fit.intercept)
    assert ours <= objective(wb, x[-1]) * 1.005
