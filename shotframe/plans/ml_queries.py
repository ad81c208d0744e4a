"""Registered feature, model, path and clustering queries.

Fits are shared per (application, dataset) so the many result tables of
one job come from one set of fits.  Feature-level queries (slots, level
index, standardisation, correlations) have DuckDB oracles; the fitted
models are checked by row counts and invariants in ``tests/``.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.derive import add_action_group
from ..operators import aggregate as A
from ..operators import archetypes as C
from ..operators import features as FE
from ..operators import kmeans as KM
from ..operators import path as PT
from ..operators.models import headline_coefficients
from ..schema import CATEGORICAL_FEATURES, HEADLINE_PENALTY, LASSO_PENALTIES, NUMERIC_FEATURES
from ..sources.shot_view import read_table
from . import clustering as CL
from . import modelling as MO
from .queries import COLS, ROW_KEYS, SHARES, given_groups, fingerprint, processed, query

# The split hashes a row key.  The view has no unique key column; these five
# together are near-unique (rows sharing all five land on the same side,
# which is harmless) and are cheap expressions of stored columns — hashing
# derived CASE columns would inline the whole view into the split filter.
SPLIT_KEYS = ROW_KEYS


def model_run(spark, sf):
    def build():
        facts = read_table(spark, sf, "lineitem").count()  # from the Parquet footers
        return MO.prepare(processed(spark, sf), COLS, split_keys=SPLIT_KEYS, partitions=MO.partitions_for(facts))
    return MO.memo_run(spark, f"model:{sf}", build)


def archetype_run(spark, sf):
    return CL.memo_archetypes(spark, f"arch:{sf}",
                              lambda: CL.run_archetypes(fingerprint(spark, sf), COLS))


# ------------------------------------------------------------ features M1-M5
@query("index_levels")
def q_index_levels(spark, sf):
    """M1: level order of every categorical feature (frequency, then name)."""
    df = add_action_group(processed(spark, sf), COLS)
    return FE.level_index(df, CATEGORICAL_FEATURES)


@query("feature_slots")
def q_feature_slots(spark, sf):
    """M1-M5: fit the feature stages on the processed table, name every slot."""
    df = add_action_group(processed(spark, sf), COLS)
    fm = FE.fit_features(df)
    return FE.slot_table(spark, FE.slot_names(fm))


@query("standardise")
def q_standardise(spark, sf):
    """Z-scores of the six shares per entity-season (MLlib StandardScaler).

    The fingerprint is checkpointed first (as in the archetype plan), so the
    scaler's fit and transform read it instead of aggregating the fact table twice.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    fp = C.assemble(fingerprint(spark, sf), SHARES).checkpoint(eager=True)
    _, scaled = C.standardise(fp)
    arr = vector_to_array("scaled")
    return scaled.select(COLS.entity, COLS.season,
                         *[F.round(arr[i], 6).alias("z_" + s) for i, s in enumerate(SHARES)])


@query("feature_corr")
def q_feature_corr(spark, sf):
    """PCA input check: pairwise correlation of the shares, one aggregate pass."""
    fp = fingerprint(spark, sf)
    pairs = [(a, b) for i, a in enumerate(SHARES) for b in SHARES[i + 1:]]
    one = fp.agg(*[F.round(F.corr(a, b), 6).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    parts = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return one.select(F.expr(f"stack({len(pairs)}, {parts}) AS (feature_a, feature_b, corr)"))


# ------------------------------------------------------------ models M6-M14
@query("lasso_path")
def q_lasso_path(spark, sf):
    return model_run(spark, sf).path()


@query("lasso_certificate")
def q_lasso_certificate(spark, sf):
    """M6 + M7: proof per penalty that the fitted path is at the optimum, from one aggregate of the training rows."""
    return model_run(spark, sf).path_certificate().select("regParam", "n_rows", "n_slots", "optimal")


@query("svm_certificate")
def q_svm_certificate(spark, sf):
    """Proof that the SVM fit is within 2 % of the optimum, by a dual bound over the training rows."""
    return model_run(spark, sf).svm_certificate().select("n_rows", "n_slots", "optimal")


@query("headline_coefs")
def q_headline(spark, sf):
    return MO.headline(model_run(spark, sf), HEADLINE_PENALTY)


@query("model_comparison")
def q_model_comparison(spark, sf):
    return model_run(spark, sf).comparison()


@query("path_active_counts")
def q_active(spark, sf):
    return PT.active_counts(model_run(spark, sf).path())


@query("path_monotone")
def q_monotone(spark, sf):
    return PT.monotone_steps(PT.active_counts(model_run(spark, sf).path()))


@query("path_wide")
def q_path_wide(spark, sf):
    run = model_run(spark, sf)
    return PT.path_wide(run.path(), run.names)


@query("path_top_features")
def q_path_top(spark, sf):
    return PT.top_features(model_run(spark, sf).path(), 8)


@query("path_entry_order")
def q_entry(spark, sf):
    return PT.entry_order(model_run(spark, sf).path())


@query("path_summary")
def q_path_summary(spark, sf):
    return PT.path_summary(model_run(spark, sf).path(), 8)


@query("coef_table")
def q_coef_table(spark, sf):
    return PT.coefficient_table(MO.headline(model_run(spark, sf), HEADLINE_PENALTY))


# ------------------------------------------------------------ clusters C1-C10
@query("pca_loadings")
def q_loadings(spark, sf):
    """C2 + C4: loadings of the components, to nine digits."""
    t = archetype_run(spark, sf).loadings()
    return t.select("feature", *[F.round(c, 9).alias(c) for c in t.columns[1:]])


@query("explained_variance")
def q_explained(spark, sf):
    """C3 + W5: share of the variance per component, to nine digits."""
    t = archetype_run(spark, sf).explained()
    return t.select("component", *[F.round(c, 9).alias(c) for c in t.columns[1:]])


@query("k_sweep")
def q_k_sweep(spark, sf):
    return archetype_run(spark, sf).sweep()


@query("kmeans_certificate")
def q_kmeans_certificate(spark, sf):
    """Points nearer to another centre than their own, and whether every centre is the mean of its points."""
    return archetype_run(spark, sf).certificate()


@query("k_sweep_certificate")
def q_k_sweep_certificate(spark, sf):
    """For every k of the sweep, the same two properties of its fit."""
    run = archetype_run(spark, sf)
    out = None
    for k in run.ks:
        columns, fit = run.pca_model.components, run.fits[k]
        one = KM.certificate(C.assign(run.points, columns, fit), columns, fit.centres)
        one = one.select(F.lit(k).alias("k"), F.lit(fit.converged).alias("converged"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("cluster_profiles")
def q_cluster_profiles(spark, sf):
    return archetype_run(spark, sf).profile()


@query("cluster_by_era")
def q_cluster_by_era(spark, sf):
    return archetype_run(spark, sf).by_era()


@query("archetype_names")
def q_archetype_names(spark, sf):
    return archetype_run(spark, sf).names()


@query("archetype_shift")
def q_archetype_shift(spark, sf):
    return archetype_run(spark, sf).shift()


@query("archetypes")
def q_archetypes(spark, sf):
    return archetype_run(spark, sf).assignments()


@query("centroids")
def q_centroids(spark, sf):
    return archetype_run(spark, sf).centroids()


# ------------------------------------------------------------ path operators on a closed-form path
# The joint fits have no SQL.  The operators over their tables are also run on the screening path, which has.
def screening(spark, sf):
    df = add_action_group(processed(spark, sf), COLS)
    return PT.screening_path(df, COLS.made_int, NUMERIC_FEATURES, CATEGORICAL_FEATURES, LASSO_PENALTIES)


@query("screen_path")
def q_screen_path(spark, sf):
    """M7 in closed form: correlations with the label, shrunk by each penalty."""
    return screening(spark, sf)


@query("screen_active_features")
def q_screen_active(spark, sf):
    """F8: features active at each penalty."""
    return PT.active_features(screening(spark, sf))


@query("screen_active_counts")
def q_screen_counts(spark, sf):
    """A10 + W11: active features per penalty and the change from the stronger one."""
    return PT.monotone_steps(PT.active_counts(screening(spark, sf)))


@query("screen_wide")
def q_screen_wide(spark, sf):
    """One column per numeric feature."""
    return PT.path_wide(screening(spark, sf), NUMERIC_FEATURES)


@query("screen_top_features")
def q_screen_top(spark, sf):
    """A12 + W9: the eight features of the largest peak."""
    return PT.top_features(screening(spark, sf), 8)


@query("screen_summary")
def q_screen_summary(spark, sf):
    """A12 + W9 + W10 + L1: peak, entry penalty, entry rank and top flag per feature."""
    return PT.path_summary(screening(spark, sf), 8)


@query("screen_coef_table")
def q_screen_coefs(spark, sf):
    """M8 + L2 + F6 + F7 + P18 + P19: the report table at the headline penalty."""
    return PT.coefficient_table(headline_coefficients(screening(spark, sf), HEADLINE_PENALTY))


# ------------------------------------------------------------ cluster tables on a given grouping
def given_profile(spark, sf):
    return A.mean_profile(given_groups(spark, sf), "cluster", SHARES, 3)


@query("group_centroids")
def q_group_centroids(spark, sf):
    """A9 + F11: size and mean shares per group."""
    return A.centroids(given_groups(spark, sf), "cluster", SHARES, digits=6)


@query("group_names")
def q_group_names(spark, sf):
    """Names read off the groups' profile."""
    return C.name_clusters(given_profile(spark, sf))


@query("group_shift")
def q_group_shift(spark, sf):
    """R13 + J2 + P21: the era table with names, signed change and label height."""
    era = A.group_comparison(given_groups(spark, sf), "cluster", "ERA", ("pre", "post"))
    return C.archetype_shift(era, C.name_clusters(given_profile(spark, sf)))
