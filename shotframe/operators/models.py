"""Supervised models (M6-M13): L1 penalty path, classifier comparison.

The penalty path takes Newton steps on one packed matrix, each fit starting
from the last penalty's coefficients (``newton.py``); every step is one
distributed aggregate whose result is a square of the vector width.  Vectors
too wide for that, and the compared classifiers, are MLlib estimators over a
cached (features, label) DataFrame, fitted from a small driver thread pool so
that their jobs overlap.  Result tables hold model parameters, certificates
and metrics only (bounded by penalties x slots), with explicit schemas.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LASSO_PENALTIES, PATH_SCHEMA
from ..sources.files import rows_to_table
from . import newton as NW
from .aggregate import binary_metrics, confusion_counts


def _fit_l1(train: DataFrame, label: str, features: str, reg: float, max_iter: int):
    lr = LogisticRegression(featuresCol=features, labelCol=label, elasticNetParam=1.0,
                            regParam=reg, maxIter=max_iter)
    return lr.fit(train)


def _mllib_path(train: DataFrame, label: str, penalties, features: str, max_iter: int, parallelism: int):
    """(penalty, coefficients, intercept) of independent MLlib fits, for vectors too wide for Newton steps."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(penalties)))) as pool:
        fit = inheritable_thread_target(lambda p: _fit_l1(train, label, features, p, max_iter))
        models = list(pool.map(fit, penalties))
    return [(p, m.coefficients.toArray(), float(m.intercept)) for p, m in zip(penalties, models)]


def path_models(train: DataFrame, width: int, label: str, penalties=LASSO_PENALTIES, features: str = "features",
                max_iter: int = 50, parallelism: int = 6, matrix: NW.Matrix | None = None):
    """M6 + M7: (penalty, coefficients on the original scale, intercept) at each penalty, in the order given."""
    pens = [float(p) for p in penalties]
    if width > NW.MOST_SLOTS:
        return _mllib_path(train, label, pens, features, max_iter, parallelism)
    own = matrix or NW.pack(train, features, label, width)
    fits = NW.l1_path(own, pens, max_iter)
    out = [(p, *own.raw(f.scaled)) for p, f in zip(pens, fits)]
    if matrix is None:
        own.release()
    return out


def path_table(spark: SparkSession, models, names) -> DataFrame:
    """M7 as a long table (regParam, feature, coefficient), in penalty and slot order."""
    if any(len(w) != len(names) for _, w, _ in models):
        raise ValueError("slot names do not match the coefficient vector")
    return rows_to_table(spark, [(p, n, float(c)) for p, w, _ in models for n, c in zip(names, w)], PATH_SCHEMA)


def penalty_path(spark: SparkSession, train: DataFrame, names, label: str,
                 penalties=LASSO_PENALTIES, features: str = "features",
                 max_iter: int = 50, parallelism: int = 6) -> DataFrame:
    """M6 + M7: L1 logistic fits at each penalty; long table (regParam, feature, coefficient).

    The objective is MLlib's: mean log-loss plus the penalty times the sizes of
    the standardised coefficients.  Rows keep the penalty order given (strong
    -> weak) and slot order.
    """
    return path_table(spark, path_models(train, len(names), label, penalties, features, max_iter, parallelism), names)


def path_certificate(spark: SparkSession, matrix: NW.Matrix, models, tolerance: float = 1e-5) -> DataFrame:
    """M6-M8: (regParam, n_rows, n_slots, residual, optimal) per penalty, from one aggregate over the training rows.

    ``residual`` is what is left of the optimality conditions (the log-loss
    gradient of each standardised slot against the penalty's subgradient); 0
    proves the global optimum of the convex problem, whatever fitted it.
    """
    left = NW.l1_residuals(matrix, models)
    rows = [(p, matrix.n, matrix.width, r, r <= tolerance) for (p, _, _), r in zip(models, left)]
    return rows_to_table(spark, rows, T.StructType([
        T.StructField("regParam", T.DoubleType()), T.StructField("n_rows", T.LongType()),
        T.StructField("n_slots", T.IntegerType()), T.StructField("residual", T.DoubleType()),
        T.StructField("optimal", T.BooleanType())]))


def svm_certificate(spark: SparkSession, matrix: NW.Matrix, w, intercept: float, l2: float, tolerance: float = 0.02) -> DataFrame:
    """(n_rows, n_slots, primal, dual, gap, optimal) of a linear SVM fit.

    No classifier has a smaller objective than ``dual``, so the fit is within
    ``gap`` (a share of the primal) of the optimum.
    """
    primal = NW.hinge_objective(matrix, w, intercept, l2)
    dual, _ = NW.hinge_dual_bound(matrix, l2, matrix.scaled(w, intercept))
    gap = (primal - dual) / primal if primal else 0.0
    return rows_to_table(spark, [(matrix.n, matrix.width, primal, dual, gap, gap <= tolerance)], T.StructType([
        T.StructField("n_rows", T.LongType()), T.StructField("n_slots", T.IntegerType()),
        T.StructField("primal", T.DoubleType()), T.StructField("dual", T.DoubleType()),
        T.StructField("gap", T.DoubleType()), T.StructField("optimal", T.BooleanType())]))


def headline_coefficients(path: DataFrame, penalty: float) -> DataFrame:
    """M8: coefficients at one penalty, ranked by magnitude (feature as tie-break).

    The penalty is matched with a relative tolerance, not float equality.
    """
    tol = abs(penalty) * 1e-9
    return (path.filter(F.abs(F.col("regParam") - penalty) <= tol)
            .select("feature", "coefficient")
            .orderBy(F.desc(F.abs("coefficient")), F.asc("feature")))


def evaluate_classifier(name: str, predictions: DataFrame, label: str,
                        exact_auc: bool = False) -> DataFrame:
    """M11-M13 for one model: ROC-AUC, weighted F1, accuracy, precision, recall.

    F1 (weighted, as MLlib's ``f1``), accuracy, precision and recall come
    from one confusion aggregate; AUC from MLlib's evaluator on the raw
    scores (``numBins=0`` for the exact curve).
    """
    auc = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC",
        numBins=0 if exact_auc else 1000).evaluate(predictions)
    m = binary_metrics(confusion_counts(predictions, label, "prediction"), digits=None)
    return m.select(F.lit(name).alias("model"), F.lit(float(auc)).alias("roc_auc"),
                    F.col("f1_weighted").alias("f1"), "accuracy", "precision", "recall",
                    "tn", "fp", "fn", "tp")


def default_classifiers(label: str, features: str = "features"):
    """M9 + M10: light-L2 logistic regression and a linear SVM."""
    return [
        ("LogisticRegression", LogisticRegression(featuresCol=features, labelCol=label,
                                                  regParam=0.01, elasticNetParam=0.0, maxIter=50)),
        ("LinearSVC", LinearSVC(featuresCol=features, labelCol=label, regParam=0.01, maxIter=50)),
    ]


def compare_classifiers(train: DataFrame, test: DataFrame, label: str,
                        classifiers=None, features: str = "features",
                        parallelism: int = 2, fitted: dict | None = None) -> DataFrame:
    """(model, roc_auc, f1, accuracy, precision, recall, tn, fp, fn, tp); the models go into ``fitted``."""
    classifiers = classifiers or default_classifiers(label, features)

    def run(item):
        name, est = item
        model = est.fit(train)
        if fitted is not None:
            fitted[name] = model
        return evaluate_classifier(name, model.transform(test), label).collect()[0]

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(classifiers)))) as pool:
        rows = list(pool.map(inheritable_thread_target(run), classifiers))
    schema = T.StructType([
        T.StructField("model", T.StringType()), T.StructField("roc_auc", T.DoubleType()),
        T.StructField("f1", T.DoubleType()), T.StructField("accuracy", T.DoubleType()),
        T.StructField("precision", T.DoubleType()), T.StructField("recall", T.DoubleType()),
        T.StructField("tn", T.LongType()), T.StructField("fp", T.LongType()),
        T.StructField("fn", T.LongType()), T.StructField("tp", T.LongType())])
    return rows_to_table(train.sparkSession, [tuple(r) for r in rows], schema)
