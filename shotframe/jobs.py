"""Batch jobs with the same inputs and outputs as the reference's five steps.

    spark-submit --py-files shotframe.zip run_job.py verify     --raw 'hdfs:///raw/*.csv' --out hdfs:///tables
    spark-submit --py-files shotframe.zip run_job.py process    --raw 'hdfs:///raw/*.csv' \
                                              --table hdfs:///processed/shots --out hdfs:///tables
    spark-submit --py-files shotframe.zip run_job.py model      --table hdfs:///processed/shots --out hdfs:///tables
    spark-submit --py-files shotframe.zip run_job.py archetypes --table hdfs:///processed/shots --out hdfs:///tables
    spark-submit --py-files shotframe.zip run_job.py era        --out hdfs:///tables

Each job writes its result tables under ``--out`` (small tables as one
header CSV each, the per-entity assignment table as Parquet) and returns
them as DataFrames when called from Python.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import aggregate as A
from .operators import cells as CE
from .operators import path as PT
from .operators import profile as Q
from .operators import trend as W
from .plans import clustering as CL
from .plans import modelling as MO
from .plans.processing import run_processing
from .schema import (BACKCOURT, DEFAULT_COLUMNS, HEADLINE_PENALTY, SEASON_TABLE_SCHEMA,
                     ShotColumns)
from .sources import files as IO


#: Columns that tell one shot from another, for the train/test split.
DEFAULT_SPLIT_KEYS = ("GAME_ID", "PLAYER_ID", "QUARTER", "MINS_LEFT", "SECS_LEFT", "LOC_X", "LOC_Y")


def _write_tables(tables: dict, out: str | None) -> None:
    if not out:
        return
    for name, df in tables.items():
        IO.write_small_csv(df, f"{out.rstrip('/')}/{name}")


def verify(spark: SparkSession, raw_glob: str, out: str | None = None,
           cols: ShotColumns = DEFAULT_COLUMNS) -> dict[str, DataFrame]:
    """Step 1: structural checks of the raw CSV files, from ONE scan.

    Row count, NULL counts, zone sanity, shot-type breakdown, season coverage
    and filter accounting all come from one table of additive cells, cached, so
    the raw CSV is parsed once instead of once per check and no raw row is
    multiplied.  ``header_columns`` lists what each distinct header names or lacks.
    """
    raw = IO.read_csv_by_name(spark, raw_glob, IO.header_schema(spark, raw_glob))
    key_cols = ["SHOT_MADE", "SHOT_MADE_FLAG", "LOC_X", "LOC_Y", "BASIC_ZONE",
                "SHOT_ZONE_BASIC", "SHOT_TYPE", "GAME_DATE"]
    present = [c for c in key_cols if c in raw.columns]
    season = Q.find_column(raw)
    n_columns = len(raw.columns)
    # checks that need a column which the files lack are left out below; the scan sees NULLs in its place
    lacking = {c for c in (cols.zone, cols.shot_type, cols.made) if c not in raw.columns}
    raw = raw.withColumns({c: F.lit(None).cast("boolean" if c == cols.made else "string") for c in lacking})
    dims = {"zone": cols.zone, "shot_type": cols.shot_type}
    if season is not None:
        dims["season"] = season
    zone, made = F.col(cols.zone), F.col(cols.made).cast("int")
    sums = {"made": made, "made_n": made.isNotNull().cast("int"), "n_removed": F.coalesce(zone == BACKCOURT, F.lit(False)).cast("int"),
            "n_kept": F.coalesce(zone != BACKCOURT, F.lit(False)).cast("int"), "n_null": zone.isNull().cast("int")}
    sums |= {f"null__{c}": F.col(CE.quoted(c)).isNull().cast("int") for c in present}
    cells = CE.value_cells(raw, dims.values(), sums).cache()
    prof, total = CE.profile_of_cells(cells, dims, sums), CE.total_of_cells(cells, sums)

    def part(label):
        return prof.filter(F.col("grouping") == label)

    parts = ", ".join(f"'{c}', 'present', null__{c}" if c in present
                      else f"'{c}', 'missing', CAST(NULL AS BIGINT)" for c in key_cols)
    shot_types = part("shot_type").select(F.col("key").alias(cols.shot_type), "n")
    tables = {
        "row_count": total.select(F.col("n").alias("n_rows"),
                                  F.lit(n_columns).alias("n_columns")),
        "null_counts": total.select(F.expr(
            f"stack({len(key_cols)}, {parts}) AS (column_name, status, null_count)")),
        "zone_sanity": part("zone").select(
            F.col("key").alias(cols.zone), F.col("n").alias("attempts"),
            F.round(F.try_divide(F.col("made"), F.col("made_n")) * 100, 1).alias("fg_pct"))
        .orderBy(F.desc("attempts"), cols.zone),
        "shot_type_breakdown": shot_types.withColumn(
            "pct", A.pct(F.col("n"), total.select("n").scalar())).orderBy(F.desc("n")),
        "removed_rows": total.select(F.col("n").alias("n_rows"), "n_removed", "n_kept", "n_null"),
        "header_columns": IO.header_columns(spark, raw_glob),
    }
    if season is not None:
        tables["season_coverage"] = part("season").select(
            F.col("key").cast(raw.schema[season].dataType).alias(season),
            F.col("n").alias("n_rows")).orderBy(season)
    elif cols.game_date in raw.columns:  # no season/year column: the first distinct game dates instead (Q6)
        tables["first_game_dates"] = Q.first_values(raw, cols.game_date, 10)
    needs = {"zone_sanity": {cols.zone, cols.made}, "removed_rows": {cols.zone}, "shot_type_breakdown": {cols.shot_type}}
    tables = {k: t for k, t in tables.items() if not needs.get(k, set()) & lacking}
    _write_tables(tables, out)
    return tables


def process(spark: SparkSession, raw_glob: str, table: str, out: str | None = None,
            cols: ShotColumns = DEFAULT_COLUMNS, rebalance: bool = True):
    """Step 2: clean, derive, partitioned Parquet, zone and season tables."""
    res = run_processing(IO.read_csv_by_name(spark, raw_glob, keep_malformed=True), table, cols, tables_path=out,
                         rebalance=rebalance)
    if not res.consistent:
        where = "" if res.published else f"; {table} is as it was, all rows by outcome are in {res.staged_path}"
        raise RuntimeError(f"written {res.n_written} rows, expected {res.n_raw - res.n_removed - res.n_null_zone}; "
                           f"{res.n_malformed} malformed lines, {res.n_mismatched} seasons differ{where}")
    return res


def model(spark: SparkSession, table: str, out: str | None = None,
          cols: ShotColumns = DEFAULT_COLUMNS, split_keys=DEFAULT_SPLIT_KEYS,
          partitions: int | None = None) -> dict[str, DataFrame]:
    """Step 3: L1 path, headline coefficients, classifier comparison.

    Rows are split by a hash of ``split_keys``, so train and test are the
    same rows for any layout of the table.
    """
    run = MO.prepare(IO.read_table(spark, table), cols, split_keys=split_keys, partitions=partitions)
    run.run_all()
    headline = MO.headline(run, HEADLINE_PENALTY)
    tables = {
        "lasso_path": run.path(),
        "lasso_coefficients": headline,
        "model_comparison": run.comparison(),
        "lasso_active_counts": PT.active_counts(run.path()),
        "lasso_path_summary": PT.path_summary(run.path()),
        "lasso_coefficient_table": PT.coefficient_table(headline),
    }
    _write_tables(tables, out)
    run.release()
    return tables


def archetypes(spark: SparkSession, table: str, out: str | None = None,
               cols: ShotColumns = DEFAULT_COLUMNS) -> dict[str, DataFrame]:
    """Step 5: fingerprint, PCA, k sweep, K-Means, profiles, era shift."""
    run = CL.run_archetypes(A.share_fingerprint(IO.read_table(spark, table), cols), cols)
    tables = {
        "cluster_profiles": run.profile(),
        "cluster_by_era": run.by_era(),
        "pca_loadings": run.loadings(),
        "pca_explained_variance": run.explained(),
        "k_sweep": run.sweep(),
        "archetype_names": run.names(),
        "archetype_shift": run.shift(),
        "centroids": run.centroids(),
    }
    _write_tables(tables, out)
    if out:
        run.assignments().write.mode("overwrite").parquet(f"{out.rstrip('/')}/player_clusters")
    tables["player_clusters"] = run.assignments()
    return tables


def era(spark: SparkSession, out: str, window=(2015, 2017),
        season: str = "SEASON_1") -> dict[str, DataFrame]:
    """Step 4: year-over-year change, steepest change, endpoints (season table)."""
    rates = IO.read_result_csv(spark, f"{out.rstrip('/')}/three_pt_rate_by_season",
                               SEASON_TABLE_SCHEMA)
    y = W.change_from_previous(rates, season, "three_pt_rate_pct")
    tables = {
        "three_pt_yoy": y,
        "three_pt_steepest": W.steepest_change(y, season),
        "three_pt_endpoints": W.endpoint_change(rates, season, "three_pt_rate_pct"),
        "three_pt_window": y.filter(y[season].between(*window)),
    }
    _write_tables({k: v for k, v in tables.items()}, f"{out.rstrip('/')}/era")
    return tables


def main(argv=None):
    ap = argparse.ArgumentParser(prog="shotframe.jobs")
    ap.add_argument("job", choices=["verify", "process", "model", "archetypes", "era"])
    ap.add_argument("--raw")
    ap.add_argument("--table")
    ap.add_argument("--out")
    ap.add_argument("--no-rebalance", action="store_true",
                    help="process: input files are one season each; skip the pre-write shuffle")
    ap.add_argument("--split-keys", default=",".join(DEFAULT_SPLIT_KEYS),
                    help="model: columns whose hash splits train and test")
    ap.add_argument("--partitions", type=int, help="model: partitions of the cached model input")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"shotframe-{a.job}").getOrCreate()
    if a.job == "verify":
        verify(spark, a.raw, a.out)
    elif a.job == "process":
        process(spark, a.raw, a.table, a.out, rebalance=not a.no_rebalance)
    elif a.job == "model":
        model(spark, a.table, a.out, split_keys=a.split_keys.split(","), partitions=a.partitions)
    elif a.job == "archetypes":
        archetypes(spark, a.table, a.out)
    else:
        era(spark, a.out)


if __name__ == "__main__":
    main()
