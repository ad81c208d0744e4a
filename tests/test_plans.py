"""Plan shape: pruning, pushdown, exchange counts, no Python in the hot path,
and partition invariance of the deterministic operators."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shotframe.operators import aggregate as A
from shotframe.plans.queries import COLS, processed, queries
from shotframe.session import scratch_path
from shotframe.sources import files as IO


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_scan_reads_only_needed_columns(spark):
    p = plan(queries()["zone_efficiency"](spark, SF_SMALL))
    lineitem_schema = [ln for ln in p.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln][0]
    for unused in ("l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"):
        assert unused not in lineitem_schema


def test_fingerprint_has_one_shuffle_pivot_has_two(spark):
    df = processed(spark, SF_SMALL)
    ours = plan(A.share_fingerprint(df, COLS), "simple")
    zones = list(COLS.zones)
    piv = plan(A.pivot_counts(df, [COLS.entity, COLS.season], COLS.zone, zones, use_pivot=True),
               "simple")
    assert ours.count("Exchange hashpartitioning") == 1
    assert piv.count("Exchange hashpartitioning") == 2


def test_partial_aggregation_before_shuffle(spark):
    p = plan(queries()["zone_efficiency"](spark, SF_SMALL))
    assert "partial_count" in p and "partial_avg" in p


@pytest.mark.parametrize("name", ["zone_efficiency", "share_fingerprint", "rate_by_season",
                                  "auc_exact", "derive_features", "index_levels"])
def test_no_python_in_plan(spark, name):
    p = plan(queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_partition_filter_reaches_scan_after_aggregate(spark):
    path = scratch_path(spark, "plan-test")
    IO.write_partitioned(processed(spark, SF_SMALL), path, COLS.season)
    fp = A.share_fingerprint(IO.read_table(spark, path), COLS).filter(F.col(COLS.season) >= 2000)
    p = plan(fp)
    assert "PartitionFilters: [isnotnull(SEASON_1" in p and "(SEASON_1#" in p


def test_pushed_filter_on_parquet(spark):
    path = scratch_path(spark, "plan-test-push")
    IO.write_partitioned(processed(spark, SF_SMALL), path, COLS.season)
    p = plan(IO.read_table(spark, path).filter(F.col("BASIC_ZONE") == "Mid-Range"))
    assert "PushedFilters: [IsNotNull(BASIC_ZONE), EqualTo(BASIC_ZONE,Mid-Range)]" in p


@pytest.mark.parametrize("name", ["zone_efficiency", "share_fingerprint", "era_shift",
                                  "entity_trend", "auc_exact", "index_levels"])
def test_partition_invariance(spark, name):
    results = []
    for n in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = queries()[name](spark, SF_SMALL)
        results.append(sorted(tuple(r) for r in df.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]


def test_one_pass_profile_is_one_scan_one_shuffle(spark):
    from shotframe.operators.profile import one_pass_profile
    from shotframe.plans.queries import shots
    p = plan(one_pass_profile(shots(spark, SF_SMALL), {"zone": "BASIC_ZONE", "type": "SHOT_TYPE",
                                                      "season": "SEASON_1"}, made="SHOT_MADE"),
             "simple")
    assert p.count("Expand") == 1
    assert p.count("Exchange hashpartitioning") == 1
    assert p.count("FileScan parquet") == 2          # lineitem + supplier, once each
