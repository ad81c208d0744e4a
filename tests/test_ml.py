"""Model and clustering invariants (ids, signs and exact values are arbitrary)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from helpers import frame, shot
from shotframe.functions import derive as D
from shotframe.operators import features as FE
from shotframe.plans.queries import queries


@pytest.fixture(scope="module")
def q():
    return queries()


def test_leakage_guard():
    with pytest.raises(FE.LeakageError):
        FE.feature_stages(numeric=["LOC_X", "EXPECTED_PTS"])


def test_unseen_and_null_categories_are_all_zero(spark):
    train = D.add_action_group(D.derive_shots(frame(spark, [
        shot(BASIC_ZONE="Mid-Range"), shot(BASIC_ZONE="Mid-Range"), shot(BASIC_ZONE="Restricted Area")])))
    test = D.add_action_group(D.derive_shots(frame(spark, [
        shot(GAME_ID=7, BASIC_ZONE="Left Corner 3"), shot(GAME_ID=8, BASIC_ZONE=None),
        shot(GAME_ID=9, LOC_X=None)])))
    fm = FE.fit_features(train)
    out = fm.transform(test)
    names = FE.slot_names(fm)
    zone_slots = [i for i, n in enumerate(names) if n.startswith("BASIC_ZONE_ohe_")]
    assert [names[i] for i in zone_slots] == ["BASIC_ZONE_ohe_Mid-Range",
                                              "BASIC_ZONE_ohe_Restricted Area"]
    rows = {r.GAME_ID: r.features.toArray() for r in out.collect()}
    assert set(rows) == {7, 8}                      # NULL numeric row skipped
    for gid in (7, 8):
        assert all(rows[gid][i] == 0 for i in zone_slots)


def test_slot_width_and_names(spark, q):
    slots = q["feature_slots"](spark, SF_ORACLE).collect()
    names = [r.feature for r in sorted(slots, key=lambda r: r.slot)]
    assert names[:8] == ["LOC_X", "LOC_Y", "SHOT_DISTANCE", "SECS_REMAINING", "IS_3PT",
                         "SHOT_VALUE", "IS_CLUTCH", "QUARTER"]
    assert len(names) == len(set(names)) == 25      # the view has 6+2+5+4 levels


def test_lasso_path_invariants(spark, q):
    path = q["lasso_path"](spark, SF_ORACLE)
    assert path.count() == 6 * 25
    counts = {r.regParam: r.n_active for r in q["path_active_counts"](spark, SF_ORACLE).collect()}
    assert counts[0.0001] >= counts[0.05]
    assert counts[0.0001] > 10
    head = q["headline_coefs"](spark, SF_ORACLE).collect()
    mags = [abs(r.coefficient) for r in head]
    assert mags == sorted(mags, reverse=True)


def test_strong_penalty_zeroes_everything(spark):
    from shotframe.operators.models import penalty_path
    from shotframe.plans.ml_queries import model_run
    run = model_run(spark, SF_ORACLE)
    p = penalty_path(spark, run.train, run.names, run.label, penalties=[10.0], max_iter=20)
    assert p.filter(F.col("coefficient") != 0).count() == 0


def test_model_comparison(spark, q):
    rows = {r.model: r for r in q["model_comparison"](spark, SF_ORACLE).collect()}
    assert set(rows) == {"LogisticRegression", "LinearSVC"}
    floor = q["majority_floor"](spark, SF_ORACLE).first().floor_accuracy
    for r in rows.values():
        assert 0.5 < r.roc_auc < 0.9              # signal, but no leakage
        assert r.accuracy > floor - 0.02
        assert r.tn + r.fp + r.fn + r.tp > 0


def test_pca_invariants(spark, q):
    load = q["pca_loadings"](spark, SF_ORACLE).collect()
    m = np.array([[r[f"PC{j}"] for j in range(1, 6)] for r in load])
    assert m.shape == (6, 5)
    assert np.allclose(m.T @ m, np.eye(5), atol=1e-8)         # orthonormal loadings
    ev = [r.explained_variance for r in q["explained_variance"](spark, SF_ORACLE).collect()]
    assert all(a >= b for a, b in zip(ev, ev[1:])) and sum(ev) <= 1 + 1e-9


def test_cluster_invariants(spark, q):
    prof = q["cluster_profiles"](spark, SF_ORACLE).collect()
    n = q["share_fingerprint"](spark, SF_ORACLE).count()
    assert len(prof) == 5 and sum(r.n for r in prof) == n
    era = q["cluster_by_era"](spark, SF_ORACLE).collect()
    assert abs(sum(r.pre_pct for r in era) - 100) < 0.5
    assert abs(sum(r.post_pct for r in era) - 100) < 0.5
    names = [r.archetype for r in q["archetype_names"](spark, SF_ORACLE).collect()]
    assert len(set(names)) == 5
    sweep = q["k_sweep"](spark, SF_ORACLE).collect()
    assert [r.k for r in sweep] == [3, 4, 5, 6, 7, 8]
    assert all(-1 <= r.silhouette <= 1 for r in sweep)
    assert q["archetypes"](spark, SF_ORACLE).count() == n


def test_archetypes_repeat_across_layouts(spark):
    """The clustering layout depends only on the data, so results repeat when
    the upstream shuffle layout changes (as it does across cluster sizes)."""
    from shotframe.plans.clustering import run_archetypes
    from shotframe.plans.queries import COLS, fingerprint
    out = []
    for n in ("3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        run = run_archetypes(fingerprint(spark, SF_ORACLE), COLS)
        out.append(sorted(tuple(r) for r in run.profile().collect()))
        run.release()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1]
