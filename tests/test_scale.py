"""Behaviour that matters at scale, checked on small inputs."""

import contextlib
import io
import random

from helpers import frame, shot
from shotframe.functions.derive import derive_shots
from shotframe.operators import aggregate as A
from conftest import SF_SMALL
from shotframe.plans.queries import queries
from shotframe.schema import DEFAULT_COLUMNS


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_large_dimension_falls_back_to_sort_merge_join(spark):
    q = queries()["zone_efficiency"]
    small = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    assert "BroadcastHashJoin" in _plan(q(spark, SF_SMALL))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = q(spark, SF_SMALL)
        assert "SortMergeJoin" in _plan(df)
        assert sorted(tuple(r) for r in df.collect()) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_key_third_of_rows_is_exact(spark):
    rnd = random.Random(3)
    zones = list(DEFAULT_COLUMNS.zones)
    rows, truth = [], {}
    for i in range(3000):
        pid = 1 if i % 3 == 0 else rnd.randint(2, 40)      # player 1 holds a third
        z = rnd.choice(zones)
        rows.append(shot(GAME_ID=i, PLAYER_ID=pid, BASIC_ZONE=z))
        truth.setdefault(pid, {}).setdefault(z, 0)
        truth[pid][z] += 1
    df = derive_shots(frame(spark, rows).repartition(7))
    fp = {r.PLAYER_ID: r for r in A.share_fingerprint(df, DEFAULT_COLUMNS, min_attempts=1).collect()}
    for pid, counts in truth.items():
        total = sum(counts.values())
        assert fp[pid].total_attempts == total
        for z, b in DEFAULT_COLUMNS.zones.items():
            assert fp[pid][b + "_cnt"] == counts.get(z, 0)
    assert fp[1].total_attempts == 1000


def test_write_rebalances_by_partition_key(spark):
    from shotframe.plans.queries import processed
    df = processed(spark, SF_SMALL).hint("rebalance", "SEASON_1")
    assert "REBALANCE_PARTITIONS_BY_COL" in _plan(df)


def test_model_input_grows_in_partitions(spark, tmp_path, monkeypatch):
    """A task's share of the model input is bounded, however many rows there are."""
    from shotframe.plans import modelling as MO
    from shotframe.plans.ml_queries import model_run
    spark.range(3000).selectExpr(
        "id AS l_orderkey", "id * 7 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "timestamp'1997-03-01' + make_interval(0, 0, 0, id % 300) AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(5).selectExpr("id AS s_suppkey", "'s' AS s_name", "1 AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(MO, "PARTITION_ROWS", 200, raising=False)
    run = model_run(spark, str(tmp_path))
    sizes = [len(p) for part in (run.train, run.test) for p in part.rdd.glom().collect()]
    assert len(sizes) == 2 * 15 and max(sizes) <= 300 and 2900 < sum(sizes) <= 3000
    run.release()
