"""Registered queries: each binds library operators to the driver's tables.

Every query takes ``(spark, sf_dir)``, reads the tables under ``sf_dir``
(through the shot view over lineitem JOIN supplier) and returns a lazy
DataFrame over the whole tables.  ``shotframe.plans.oracle`` holds the
DuckDB text of each SQL-expressible query; the model and clustering
queries have none (checked by row count and invariants in ``tests/``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import derive as D
from ..functions import text as X
from ..operators import aggregate as A
from ..operators import cells as CE
from ..operators import evaluate as E
from ..operators import profile as Q
from ..operators import select as S
from ..operators import trend as W
from ..schema import (ACTION_RULES, BACK_COURT_RANGE, BACKCOURT, CATEGORICAL_FEATURES,
                      NUMERIC_FEATURES, THREE_PT_TYPE, THREE_PT_ZONES)
from ..session import ensure_checkpoint_dir
from ..sources.shot_view import (VIEW_COLUMNS, VIEW_POINT_SEASON, VIEW_RECENT_SEASON,
                                 VIEW_WINDOW, read_table, shot_view)

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
COLS = VIEW_COLUMNS
SHARES = A.share_columns(COLS)


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ----------------------------------------------------------------- inputs
def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw shot view (17 columns)."""
    return shot_view(spark, sf_dir)


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed fact table: derived columns, backcourt rows removed (F1)."""
    return S.exclude_value(D.derive_shots(shots(spark, sf_dir), COLS), COLS.zone, BACKCOURT)


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-season share fingerprint (A4)."""
    return A.share_fingerprint(processed(spark, sf_dir), COLS)


def season_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rate_by_period(processed(spark, sf_dir), COLS.season)


# Rule-based prediction and integer score used by the metric queries:
# predict "made" for shots inside 10 ft; score = closeness to the rim.
def _with_prediction(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "prediction": F.when(F.col("SHOT_DISTANCE") < 10, 1).otherwise(0),
        "score": (F.lit(40) - F.col("SHOT_DISTANCE")).cast("int"),
    })


# ------------------------------------------------------------- flagship A1
@query("zone_efficiency")
def q_zone_efficiency(spark, sf):
    """A1: attempts, FG % and points per attempt by zone."""
    return A.efficiency_by(processed(spark, sf), COLS.zone)


@query("rate_by_season")
def q_rate_by_season(spark, sf):
    """A2: three-point rate and FG % by season."""
    return season_rates(spark, sf)


@query("zone_season_cells")
def q_cells(spark, sf):
    """A1 + A2 in one pass: additive cells per (zone, season)."""
    return A.zone_period_cells(processed(spark, sf), COLS.zone, COLS.season)


@query("zone_efficiency_from_cells")
def q_eff_cells(spark, sf):
    return A.efficiency_from_cells(q_cells(spark, sf), COLS.zone)


@query("rate_from_cells")
def q_rate_cells(spark, sf):
    return A.rate_from_cells(q_cells(spark, sf), COLS.season)


# -------------------------------------------------------------- profiling Q
@query("profile_counts")
def q_profile_counts(spark, sf):
    return Q.row_and_column_count(shots(spark, sf))


@query("profile_nulls")
def q_profile_nulls(spark, sf):
    """Q2/Q3: NULLs for every column, plus the two names the data lacks."""
    df = shots(spark, sf)
    return Q.null_profile(df, df.columns + ["SHOT_MADE_FLAG", "SHOT_ZONE_BASIC"])


@query("profile_coverage")
def q_profile_coverage(spark, sf):
    """Q4 + Q5: discover the season column by name, rows per season."""
    return Q.coverage(shots(spark, sf))


@query("profile_first_dates")
def q_first_dates(spark, sf):
    return Q.first_values(shots(spark, sf), COLS.game_date, 10)


@query("profile_breakdown")
def q_breakdown(spark, sf):
    return Q.breakdown(shots(spark, sf), COLS.shot_type)


@query("action_breakdown")
def q_action_breakdown(spark, sf):
    """Q7 + W8: the 30 most frequent raw actions."""
    return Q.breakdown(processed(spark, sf), COLS.action, top=30)


@query("zone_sanity")
def q_zone_sanity(spark, sf):
    """Q9: attempts and FG % per zone on the raw rows (before the filter)."""
    raw = shots(spark, sf).withColumn("made_int", D.bool_to_int(COLS.made))
    return A.efficiency_by(raw, COLS.zone, made="made_int", points=None)


@query("label_balance")
def q_label_balance(spark, sf):
    return Q.breakdown(processed(spark, sf), COLS.made_int)


@query("majority_floor")
def q_majority_floor(spark, sf):
    return A.majority_floor(processed(spark, sf), COLS.made_int)


@query("verify_cells")
def q_verify_cells(spark, sf):
    """Q5 + Q7 + Q9 + Q1 from additive cells: one aggregate of the facts, grouping sets over its rows."""
    dims = {"zone": COLS.zone, "shot_type": COLS.shot_type, "season": COLS.season}
    made = F.col(COLS.made).cast("int")
    cells = CE.value_cells(shots(spark, sf), dims.values(), {"made": made, "made_n": made.isNotNull().cast("int")})
    return CE.profile_of_cells(cells, dims, ["made", "made_n"])


@query("sketched_distincts")
def q_sketched_distincts(spark, sf):
    """Q11 for unbounded domains: games and players per season by sketches kept per (season, zone)
    and merged, held against the exact counts."""
    df = shots(spark, sf)
    cells = CE.sketch_cells(df, [COLS.season, COLS.zone], ["GAME_ID", COLS.entity])
    merged = CE.distincts_of_sketches(cells, [COLS.season], ["GAME_ID", COLS.entity])
    exact = df.groupBy(COLS.season).agg(F.count_distinct("GAME_ID").alias("n_games"), F.count_distinct(COLS.entity).alias("n_players"))

    def close(estimate, count):
        return F.abs(F.col(estimate) - F.col(count)) <= F.greatest(F.lit(1.0), 0.03 * F.col(count))
    return merged.join(exact, COLS.season).select(COLS.season, "n", "n_games", "n_players",
                                                  close("GAME_ID", "n_games").alias("games_close"),
                                                  close(COLS.entity, "n_players").alias("players_close"))


@query("profile_distinct")
def q_profile_distinct(spark, sf):
    df = D.add_action_group(processed(spark, sf), COLS, ACTION_RULES)
    return Q.distinct_counts(df, CATEGORICAL_FEATURES)


@query("removed_rows")
def q_removed_rows(spark, sf):
    return Q.filter_accounting(shots(spark, sf), COLS.zone, BACKCOURT)


@query("share_invariant")
def q_share_invariant(spark, sf):
    return Q.sum_invariant(fingerprint(spark, sf), SHARES)


@query("profile_quantiles")
def q_profile_quantiles(spark, sf):
    ensure_checkpoint_dir(spark)  # the passes of the selection read the fingerprint, not the facts
    fp = fingerprint(spark, sf).select("total_attempts").checkpoint(eager=True)
    return Q.quantile_summary(fp, "total_attempts", exact=True)


@query("residual_check")
def q_residual(spark, sf):
    """Q15: rows whose range still says back court after the zone filter."""
    return processed(spark, sf).agg(
        F.count_if(F.col(COLS.zone_range) == BACK_COURT_RANGE).alias("residual_rows"),
        F.count(F.lit(1)).alias("kept_rows"))


@query("consistency_crosstab")
def q_crosstab(spark, sf):
    return Q.crosstab_consistency(shots(spark, sf), COLS.zone, COLS.shot_type,
                                  THREE_PT_ZONES, THREE_PT_TYPE)


@query("usable_rows")
def q_usable(spark, sf):
    return Q.usable_rows(processed(spark, sf), NUMERIC_FEATURES)


# ---------------------------------------------------------------- derive P
@query("derive_features")
def q_derive_features(spark, sf):
    """P1-P7 + F1: the processed fact table, row level."""
    return processed(spark, sf)


@query("derive_dates")
def q_derive_dates(spark, sf):
    """Parsed date range and unparsed count per season."""
    df = D.derive_shots(shots(spark, sf), COLS)
    return (df.groupBy(COLS.season)
            .agg(F.min("GAME_DATE_PARSED").alias("first_date"),
                 F.max("GAME_DATE_PARSED").alias("last_date"),
                 F.count_if(F.col("GAME_DATE_PARSED").isNull()
                            & F.col(COLS.game_date).isNotNull()).alias("n_unparsed"))
            .orderBy(COLS.season))


@query("bucket_actions")
def q_bucket_actions(spark, sf):
    """Raw action -> bucket, with row counts."""
    df = D.add_action_group(processed(spark, sf), COLS, ACTION_RULES)
    return (df.groupBy(COLS.action, COLS.action_group)
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), COLS.action))


@query("clutch_profile")
def q_clutch(spark, sf):
    """P3 + P6 + A1: efficiency of clutch vs other attempts."""
    return A.efficiency_by(processed(spark, sf), "IS_CLUTCH")


@query("format_table")
def q_format_table(spark, sf):
    """P20: the zone table as report text."""
    return X.format_zone_table(q_zone_efficiency(spark, sf))


# --------------------------------------------------------- fingerprint A3-A8
@query("share_fingerprint")
def q_fingerprint(spark, sf):
    return fingerprint(spark, sf)


@query("pivot_zone_counts")
def q_pivot_counts(spark, sf):
    """A3 with ``pivot`` and a guarded fill (NULL keys stay NULL)."""
    zones = list(COLS.zones)
    names = [b + "_cnt" for b in COLS.zones.values()]
    return A.pivot_counts(processed(spark, sf), [COLS.entity, COLS.season], COLS.zone,
                          zones, names, use_pivot=True)


@query("top_volume")
def q_top_volume(spark, sf):
    """F3 + W8: the 10 largest recent entity-seasons by attempts."""
    fp = S.since(fingerprint(spark, sf), COLS.season, VIEW_RECENT_SEASON)
    return (fp.orderBy(F.desc("total_attempts"), COLS.entity, COLS.season)
            .select(COLS.entity, COLS.entity_name, COLS.season, "total_attempts", *SHARES)
            .limit(10))


@query("feature_means")
def q_feature_means(spark, sf):
    return A.global_means(fingerprint(spark, sf), SHARES, digits=6)


@query("era_totals")
def q_era_totals(spark, sf):
    return A.group_totals(fingerprint(spark, sf), "ERA")


def given_groups(spark, sf):
    # A given grouping for the profile/era operators (entity id mod 5),
    # so they can be checked without a clustering model.
    return fingerprint(spark, sf).withColumn("cluster", (F.col(COLS.entity) % 5).cast("int"))


@query("group_profile")
def q_group_profile(spark, sf):
    return A.mean_profile(given_groups(spark, sf), "cluster", SHARES, 3)


@query("era_shift")
def q_era_shift(spark, sf):
    return A.group_comparison(given_groups(spark, sf), "cluster", "ERA", ("pre", "post"))


# ------------------------------------------------------------------ trend W
@query("yoy_change")
def q_yoy(spark, sf):
    return W.change_from_previous(season_rates(spark, sf), COLS.season, "three_pt_rate_pct")


@query("steepest_change")
def q_steepest(spark, sf):
    return W.steepest_change(q_yoy(spark, sf), COLS.season)


@query("endpoint_change")
def q_endpoint(spark, sf):
    return W.endpoint_change(season_rates(spark, sf), COLS.season, "three_pt_rate_pct")


@query("entity_trend")
def q_entity_trend(spark, sf):
    """W1 + W2 per entity: each entity's steepest season-over-season rise in
    its three-point share (windows partitioned by entity)."""
    fp = fingerprint(spark, sf).withColumn(
        "three_share_pct", F.round((F.col("lc3_share") + F.col("rc3_share")
                                    + F.col("atb3_share")) * 100, 1))
    ch = W.change_from_previous(fp, COLS.season, "three_share_pct", partition=[COLS.entity])
    return W.steepest_change(ch, COLS.season, partition=[COLS.entity]).select(
        COLS.entity, COLS.season, "prev_" + COLS.season, "three_share_pct", "yoy_change")


@query("point_lookup")
def q_point_lookup(spark, sf):
    """the rate in one season."""
    return S.point_value(season_rates(spark, sf), COLS.season, VIEW_POINT_SEASON,
                         "three_pt_rate_pct", "rate_at_season")


@query("era_report")
def q_era_report(spark, sf):
    """E1 = A2 + W1 + W2 + F10: per season rate, change, window and steepest flags, from one yearly table."""
    lo, hi = VIEW_WINDOW
    return (q_yoy(spark, sf)
            .select(COLS.season, "three_pt_rate_pct", "yoy_change",
                    S.window_flag(COLS.season, lo, hi).alias("in_window"),
                    W.is_steepest(COLS.season).alias("is_steepest"))
            .orderBy(COLS.season))


# ---------------------------------------------------------- metrics A13 M11
@query("confusion")
def q_confusion(spark, sf):
    return A.confusion_counts(_with_prediction(processed(spark, sf)), COLS.made_int, "prediction")


@query("classification_metrics")
def q_metrics(spark, sf):
    return A.binary_metrics(q_confusion(spark, sf))


@query("auc_exact")
def q_auc(spark, sf):
    return E.auc_rank(_with_prediction(processed(spark, sf)), COLS.made_int, "score")


# ------------------------------------------------------- W4, F4, generic tables
@query("zone_relative_gap")
def q_zone_gap(spark, sf):
    """Points per attempt of each zone relative to the mid-range base
    ("32 % more"); the base value comes from a window over the zone table."""
    return A.relative_to(q_zone_efficiency(spark, sf), COLS.zone, "pts_per_attempt", "Mid-Range")


#: Columns that tell rows of the view apart, for samples and splits.
ROW_KEYS = ["GAME_ID", "QUARTER", "PLAYER_ID", "SECS_LEFT", "LOC_X"]


@query("sampled_zone_efficiency")
def q_sampled(spark, sf):
    """the zone table on a repeatable 5 % sample (hash of the row key)."""
    return A.efficiency_by(S.key_sample(processed(spark, sf), ROW_KEYS, 0.05, 42), COLS.zone)


@query("split_counts")
def q_split_counts(spark, sf):
    """rows and makes of each part of the repeatable 80/20 split, per season."""
    parts = S.key_split(processed(spark, sf), ROW_KEYS, (0.8, 0.2), 42)
    counted = [p.groupBy(COLS.season).agg(F.count(F.lit(1)).alias("n"), F.sum(COLS.made_int).cast("long").alias("n_made"))
               .select(F.lit(name).alias("part"), COLS.season, "n", "n_made") for name, p in zip(("train", "test"), parts)]
    return counted[0].unionByName(counted[1])


@query("events_breakdown")
def q_events_breakdown(spark, sf):
    """Q7 + Q8 on another fact table: events per type with share of total."""
    return Q.breakdown(read_table(spark, sf, "events"), "event_type")


@query("events_nulls")
def q_events_nulls(spark, sf):
    """Q2 on another fact table: NULLs per column of ``events``."""
    return Q.null_profile(read_table(spark, sf, "events"))


@query("lineitem_quantiles")
def q_lineitem_quantiles(spark, sf):
    """Q14 on another fact table: exact quantiles of l_quantity."""
    return Q.quantile_summary(read_table(spark, sf, "lineitem"), "l_quantity", exact=True)


@query("price_quantiles")
def q_price_quantiles(spark, sf):
    """Q14 on nearly distinct values: exact quantiles of l_extendedprice by distributed selection."""
    return Q.quantile_summary(read_table(spark, sf, "lineitem"), "l_extendedprice", probs=(0.01, 0.25, 0.5, 0.75, 0.99),
                              exact=True, digits=6)


@query("events_daily_trend")
def q_events_trend(spark, sf):
    """W1 + W2 on ``events``: events per type and day, change from the
    previous day of that type, and each type's steepest rise (windows
    partitioned by type)."""
    daily = (read_table(spark, sf, "events")
             .groupBy("event_type", F.to_date("ts").alias("day"))
             .agg(F.count(F.lit(1)).alias("n")))
    ch = W.change_from_previous(daily, "day", "n", partition=["event_type"], out="day_change",
                                digits=None)
    return W.steepest_change(ch, "day", "day_change", partition=["event_type"]).select(
        "event_type", "day", "prev_day", "n", "day_change")


@query("documents_breakdown")
def q_documents_breakdown(spark, sf):
    """Q7 + Q8 on ``documents``: documents per language with share of total."""
    return Q.breakdown(read_table(spark, sf, "documents"), "lang")


@query("orders_first_dates")
def q_orders_first_dates(spark, sf):
    """Q6 on ``orders``: the ten earliest order dates."""
    return Q.first_values(read_table(spark, sf, "orders"), "o_orderdate", 10)


@query("verify_one_pass")
def q_verify_one_pass(spark, sf):
    """Q5 + Q7 + Q9 + Q1 in one scan (grouping sets): rows and makes per zone,
    per shot type, per season and overall."""
    return Q.one_pass_profile(shots(spark, sf), {"zone": COLS.zone, "shot_type": COLS.shot_type,
                                                 "season": COLS.season}, made=COLS.made)


def queries() -> dict[str, QueryFn]:
    # Import for registration side effects (model / clustering / IO queries).
    from . import ml_queries  # noqa: F401
    from . import io_queries  # noqa: F401
    return dict(REGISTRY)
