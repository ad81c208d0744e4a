"""The five batch jobs end to end on raw CSV files in the reference's 26-column layout."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shotframe import jobs
from shotframe.plans.queries import shots
from shotframe.schema import RAW_SHOT_SCHEMA
from shotframe.session import scratch_path
from shotframe.sources.shot_view import VIEW_COLUMNS


def _raw_csv(spark):
    view = shots(spark, SF_SMALL)
    cols = [F.col(f.name) if f.name in view.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in RAW_SHOT_SCHEMA.fields]
    path = scratch_path(spark, "raw-26")
    # one file per season, as the reference's input
    view.select(*cols).repartition("SEASON_1").write.option("header", True).csv(path)
    return path + "/*.csv", view


def test_jobs_end_to_end(spark):
    glob, view = _raw_csv(spark)
    out = scratch_path(spark, "tables")
    table = scratch_path(spark, "processed")

    v = jobs.verify(spark, glob, out, VIEW_COLUMNS)
    assert v["row_count"].first().n_rows == view.count()
    assert v["row_count"].first().n_columns == 26
    status = {r.column_name: r.status for r in v["null_counts"].collect()}
    assert status["SHOT_MADE_FLAG"] == "missing" and status["SHOT_MADE"] == "present"
    # the one-pass tables equal the checks computed one by one
    from shotframe.operators import aggregate as AG
    from shotframe.operators import profile as PR
    raw = spark.read.schema(RAW_SHOT_SCHEMA).option("header", True).csv(glob)
    direct = AG.efficiency_by(raw.withColumn("m", F.col("SHOT_MADE").cast("int")), "BASIC_ZONE",
                              made="m", points=None)
    assert sorted(map(tuple, v["zone_sanity"].collect())) == sorted(map(tuple, direct.collect()))
    assert sorted(map(tuple, v["season_coverage"].collect())) == \
        sorted(map(tuple, PR.coverage(raw).collect()))
    assert v["removed_rows"].first().asDict() == \
        PR.filter_accounting(raw, "BASIC_ZONE", "Backcourt").first().asDict()

    res = jobs.process(spark, glob, table, out, VIEW_COLUMNS)
    assert res.consistent and res.n_raw == view.count()
    back = spark.read.parquet(table)
    assert "GAME_DATE_PARSED" in back.columns and back.columns[-1] == "SEASON_1"
    zone_csv = spark.read.option("header", True).csv(out + "/fg_pct_by_zone")
    assert zone_csv.count() == 6

    m = jobs.model(spark, table, out, VIEW_COLUMNS)
    assert m["model_comparison"].count() == 2
    assert m["lasso_path"].count() == 6 * len(m["lasso_coefficients"].collect())

    a = jobs.archetypes(spark, table, out, VIEW_COLUMNS)
    n = a["player_clusters"].count()
    assert n > 0 and sum(r.n for r in a["cluster_profiles"].collect()) == n
    assert spark.read.parquet(out + "/player_clusters").count() == n

    e = jobs.era(spark, out, window=(1997, 1999))
    assert e["three_pt_steepest"].count() == 1
    assert e["three_pt_window"].count() == 3


def test_process_without_rebalance_matches(spark):
    glob, view = _raw_csv(spark)
    a = jobs.process(spark, glob, scratch_path(spark, "p-reb"), None, VIEW_COLUMNS)
    b = jobs.process(spark, glob, scratch_path(spark, "p-noreb"), None, VIEW_COLUMNS, rebalance=False)
    assert a.n_written == b.n_written
    assert sorted(map(tuple, a.season_table.collect())) == sorted(map(tuple, b.season_table.collect()))
