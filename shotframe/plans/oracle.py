"""DuckDB text of every SQL-expressible registered query.

Each string runs on DuckDB with the driver tables registered as views.  The
shot view, the processed table and the fingerprint are shared CTEs; column
names and types are aliased to match the Spark results (DuckDB ``sum`` of
integers is HUGEINT, so sums are cast to BIGINT).
"""

from __future__ import annotations

from ..functions.text import ACTION_PREFIX, CONTEXT_FEATURES, LABEL_REPLACEMENTS
from ..operators.archetypes import ARCHETYPE_SIGNATURES, VERSATILE_NAME
from ..schema import HEADLINE_PENALTY, K_RANGE, LASSO_PENALTIES, N_PCA, ZONE_TO_BASE
from ..sources.shot_view import (VIEW_COLUMNS, VIEW_POINT_SEASON, VIEW_RECENT_SEASON,
                                 VIEW_WINDOW, duckdb_view_sql)

ORACLE: dict[str, str] = {}
_BASES = list(ZONE_TO_BASE.values())
_SHARES = [b + "_share" for b in _BASES]
_ERA = VIEW_COLUMNS.era_split
_MIN = VIEW_COLUMNS.min_attempts

_PROCESSED = """processed AS (
 SELECT *, CAST(SHOT_MADE AS INT) AS SHOT_MADE_INT,
  CAST(try_strptime(GAME_DATE, '%m-%d-%Y') AS DATE) AS GAME_DATE_PARSED,
  MINS_LEFT*60 + SECS_LEFT AS SECS_REMAINING,
  CASE WHEN SHOT_TYPE = '3PT Field Goal' THEN 1 ELSE 0 END AS IS_3PT,
  CASE WHEN SHOT_TYPE = '3PT Field Goal' THEN 3 ELSE 2 END AS SHOT_VALUE,
  CASE WHEN QUARTER >= 4 AND MINS_LEFT*60 + SECS_LEFT <= 120 THEN 1 ELSE 0 END AS IS_CLUTCH,
  (CASE WHEN SHOT_TYPE = '3PT Field Goal' THEN 3 ELSE 2 END) * CAST(SHOT_MADE AS INT) AS EXPECTED_PTS
 FROM shots WHERE BASIC_ZONE <> 'Backcourt')"""

_ACTION_GROUP = """CASE
  WHEN contains(lower(ACTION_TYPE), 'dunk') THEN 'Dunk'
  WHEN contains(lower(ACTION_TYPE), 'layup') THEN 'Layup'
  WHEN contains(lower(ACTION_TYPE), 'hook') THEN 'Hook'
  WHEN contains(lower(ACTION_TYPE), 'jump') OR contains(lower(ACTION_TYPE), 'fade')
    OR contains(lower(ACTION_TYPE), 'pullup') OR contains(lower(ACTION_TYPE), 'pull-up')
    OR contains(lower(ACTION_TYPE), 'step back') OR contains(lower(ACTION_TYPE), 'stepback')
    OR contains(lower(ACTION_TYPE), 'turnaround') OR contains(lower(ACTION_TYPE), 'floating')
    THEN 'Jump Shot'
  ELSE 'Other' END"""

_FP = (
    "fp0 AS (SELECT PLAYER_ID, PLAYER_NAME, SEASON_1, "
    + ", ".join(f"CAST(count_if(BASIC_ZONE = '{z}') AS BIGINT) AS {b}_cnt"
                for z, b in ZONE_TO_BASE.items())
    + " FROM processed GROUP BY PLAYER_ID, PLAYER_NAME, SEASON_1),\n"
    + "fp1 AS (SELECT *, " + " + ".join(f"{b}_cnt" for b in _BASES)
    + " AS total_attempts FROM fp0),\n"
    + "fp AS (SELECT *, "
    + ", ".join(f"CAST({b}_cnt AS DOUBLE) / total_attempts AS {b}_share" for b in _BASES)
    + f", CASE WHEN SEASON_1 >= {_ERA} THEN 'post' ELSE 'pre' END AS ERA"
    + f" FROM fp1 WHERE total_attempts >= {_MIN})"
)

_RATES = """rates AS (
 SELECT SEASON_1, CAST(count(*) AS BIGINT) AS total_attempts,
  CAST(sum(IS_3PT) AS BIGINT) AS three_pt_attempts,
  round(sum(IS_3PT) / count(*) * 100, 1) AS three_pt_rate_pct,
  round(avg(SHOT_MADE_INT) * 100, 1) AS overall_fg_pct
 FROM processed GROUP BY SEASON_1)"""

_YOY = """yoy AS (
 SELECT *, lag(SEASON_1) OVER (ORDER BY SEASON_1) AS prev_SEASON_1,
  round(three_pt_rate_pct - lag(three_pt_rate_pct) OVER (ORDER BY SEASON_1), 1) AS yoy_change
 FROM rates)"""

_CELLS = """cells AS (
 SELECT BASIC_ZONE, SEASON_1, CAST(count(*) AS BIGINT) AS attempts,
  CAST(sum(SHOT_MADE_INT) AS BIGINT) AS made, CAST(count(SHOT_MADE_INT) AS BIGINT) AS made_n,
  CAST(sum(IS_3PT) AS BIGINT) AS flagged, CAST(sum(EXPECTED_PTS) AS BIGINT) AS points,
  CAST(count(EXPECTED_PTS) AS BIGINT) AS points_n
 FROM processed GROUP BY BASIC_ZONE, SEASON_1)"""

_PRED = """pred AS (
 SELECT *, CASE WHEN SHOT_DISTANCE < 10 THEN 1 ELSE 0 END AS prediction,
  CAST(40 - SHOT_DISTANCE AS INT) AS score FROM processed)"""

_CONF = """conf AS (
 SELECT CAST(count_if(SHOT_MADE_INT = 0 AND prediction = 0) AS BIGINT) AS tn,
  CAST(count_if(SHOT_MADE_INT = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(count_if(SHOT_MADE_INT = 1 AND prediction = 0) AS BIGINT) AS fn,
  CAST(count_if(SHOT_MADE_INT = 1 AND prediction = 1) AS BIGINT) AS tp FROM pred)"""


def with_ctes(body: str) -> str:
    """Prefix the shared CTEs; a body starting with ``,`` adds its own CTEs."""
    ctes = [duckdb_view_sql(), _PROCESSED, _FP, _RATES, _YOY, _CELLS, _PRED, _CONF]
    return "WITH " + ",\n".join(ctes) + ("" if body.startswith(",") else "\n") + body


def sql(name: str, body: str) -> None:
    ORACLE[name] = with_ctes(body)


def _union(selects) -> str:
    return "\nUNION ALL\n".join(selects)


_VIEW_COLS = ["SEASON_1", "PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "GAME_ID", "GAME_DATE",
              "SHOT_MADE", "ACTION_TYPE", "SHOT_TYPE", "BASIC_ZONE", "ZONE_RANGE", "LOC_X",
              "LOC_Y", "SHOT_DISTANCE", "QUARTER", "MINS_LEFT", "SECS_LEFT"]

# ------------------------------------------------------------------ A1, A2
sql("zone_efficiency", """SELECT BASIC_ZONE, CAST(count(*) AS BIGINT) AS attempts,
 round(avg(SHOT_MADE_INT) * 100, 1) AS fg_pct, round(avg(EXPECTED_PTS), 3) AS pts_per_attempt
FROM processed GROUP BY BASIC_ZONE ORDER BY pts_per_attempt DESC""")
sql("rate_by_season", "SELECT * FROM rates ORDER BY SEASON_1")
sql("zone_season_cells", "SELECT * FROM cells")
sql("zone_efficiency_from_cells", """SELECT BASIC_ZONE, CAST(sum(attempts) AS BIGINT) AS attempts,
 round(sum(made) / sum(made_n) * 100, 1) AS fg_pct,
 round(sum(points) / sum(points_n), 3) AS pts_per_attempt FROM cells GROUP BY BASIC_ZONE""")
sql("rate_from_cells", """SELECT SEASON_1, CAST(sum(attempts) AS BIGINT) AS total_attempts,
 CAST(sum(flagged) AS BIGINT) AS three_pt_attempts,
 round(sum(flagged) / sum(attempts) * 100, 1) AS three_pt_rate_pct,
 round(sum(made) / sum(made_n) * 100, 1) AS overall_fg_pct FROM cells GROUP BY SEASON_1""")

# ------------------------------------------------------------------ Q
sql("profile_counts", f"SELECT CAST(count(*) AS BIGINT) AS n_rows, {len(_VIEW_COLS)} AS n_columns FROM shots")
_null_cols = _VIEW_COLS + ["SHOT_MADE_FLAG", "SHOT_ZONE_BASIC"]
sql("profile_nulls", _union(
    [f"SELECT '{c}' AS column_name, 'present' AS status, "
     f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM shots" for c in _VIEW_COLS]
    + [f"SELECT '{c}' AS column_name, 'missing' AS status, CAST(NULL AS BIGINT) AS null_count"
       for c in _null_cols[len(_VIEW_COLS):]]))
sql("profile_coverage", "SELECT SEASON_1, CAST(count(*) AS BIGINT) AS n_rows FROM shots GROUP BY SEASON_1")
sql("profile_first_dates", "SELECT DISTINCT GAME_DATE FROM shots ORDER BY GAME_DATE LIMIT 10")
sql("profile_breakdown", """SELECT SHOT_TYPE, n, round(CAST(n AS DOUBLE) / sum(n) OVER () * 100, 1) AS pct
FROM (SELECT SHOT_TYPE, CAST(count(*) AS BIGINT) AS n FROM shots GROUP BY SHOT_TYPE)""")
sql("action_breakdown", """SELECT ACTION_TYPE, n, round(CAST(n AS DOUBLE) / sum(n) OVER () * 100, 1) AS pct
FROM (SELECT ACTION_TYPE, CAST(count(*) AS BIGINT) AS n FROM processed GROUP BY ACTION_TYPE)
ORDER BY n DESC, ACTION_TYPE LIMIT 30""")
sql("zone_sanity", """SELECT BASIC_ZONE, CAST(count(*) AS BIGINT) AS attempts,
 round(avg(CAST(SHOT_MADE AS INT)) * 100, 1) AS fg_pct FROM shots GROUP BY BASIC_ZONE""")
sql("label_balance", """SELECT SHOT_MADE_INT, n, round(CAST(n AS DOUBLE) / sum(n) OVER () * 100, 1) AS pct
FROM (SELECT SHOT_MADE_INT, CAST(count(*) AS BIGINT) AS n FROM processed GROUP BY SHOT_MADE_INT)""")
sql("majority_floor", """SELECT max(n) AS majority_n, CAST(sum(n) AS BIGINT) AS n,
 round(max(n) / sum(n), 10) AS floor_accuracy
FROM (SELECT SHOT_MADE_INT, CAST(count(*) AS BIGINT) AS n FROM processed GROUP BY SHOT_MADE_INT)""")
sql("profile_distinct", "SELECT * FROM (" + _union(
    [f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
     f" AS BIGINT) AS n_distinct FROM (SELECT *, {_ACTION_GROUP} AS ACTION_GROUP FROM processed)"
     for c in ["BASIC_ZONE", "SHOT_TYPE", "ZONE_RANGE", "ACTION_GROUP"]]) + ")")
sql("removed_rows", """SELECT CAST(count(*) AS BIGINT) AS n_rows,
 CAST(count_if(BASIC_ZONE = 'Backcourt') AS BIGINT) AS n_removed,
 CAST(count_if(BASIC_ZONE <> 'Backcourt') AS BIGINT) AS n_kept,
 CAST(count_if(BASIC_ZONE IS NULL) AS BIGINT) AS n_null FROM shots""")
_share_sum = " + ".join(_SHARES)
sql("share_invariant", f"""SELECT min({_share_sum}) AS share_sum_min, max({_share_sum}) AS share_sum_max,
 CAST(count(*) AS BIGINT) AS n_groups FROM fp""")
sql("profile_quantiles", """SELECT min(total_attempts) AS min,
 quantile_cont(total_attempts, 0.25) AS p25, quantile_cont(total_attempts, 0.5) AS p50,
 quantile_cont(total_attempts, 0.75) AS p75, max(total_attempts) AS max FROM fp""")
sql("residual_check", """SELECT CAST(count_if(ZONE_RANGE = 'Back Court Shot') AS BIGINT) AS residual_rows,
 CAST(count(*) AS BIGINT) AS kept_rows FROM processed""")
sql("consistency_crosstab", """SELECT BASIC_ZONE, SHOT_TYPE, CAST(count(*) AS BIGINT) AS n,
 (BASIC_ZONE IN ('Left Corner 3', 'Right Corner 3', 'Above the Break 3', 'Backcourt'))
   = (SHOT_TYPE = '3PT Field Goal') AS consistent
FROM shots GROUP BY BASIC_ZONE, SHOT_TYPE""")
_num = ["LOC_X", "LOC_Y", "SHOT_DISTANCE", "SECS_REMAINING", "IS_3PT", "SHOT_VALUE",
        "IS_CLUTCH", "QUARTER"]
_ok = " AND ".join(f"(CAST({c} AS DOUBLE) IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)))" for c in _num)
sql("usable_rows", f"""SELECT n_rows, n_usable, n_rows - n_usable AS n_skipped FROM (
 SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count_if({_ok}) AS BIGINT) AS n_usable FROM processed)""")

# ------------------------------------------------------------------ P
sql("derive_features", "SELECT * FROM processed")
sql("derive_dates", """SELECT SEASON_1, min(d) AS first_date, max(d) AS last_date,
 CAST(count_if(d IS NULL AND GAME_DATE IS NOT NULL) AS BIGINT) AS n_unparsed
FROM (SELECT SEASON_1, GAME_DATE, CAST(try_strptime(GAME_DATE, '%m-%d-%Y') AS DATE) AS d FROM shots)
GROUP BY SEASON_1""")
sql("bucket_actions", f"""SELECT ACTION_TYPE, {_ACTION_GROUP} AS ACTION_GROUP, CAST(count(*) AS BIGINT) AS n
FROM processed GROUP BY ALL""")
sql("clutch_profile", """SELECT IS_CLUTCH, CAST(count(*) AS BIGINT) AS attempts,
 round(avg(SHOT_MADE_INT) * 100, 1) AS fg_pct, round(avg(EXPECTED_PTS), 3) AS pts_per_attempt
FROM processed GROUP BY IS_CLUTCH""")
sql("format_table", """SELECT BASIC_ZONE AS "Zone", format('{:,}', attempts) AS "Attempts",
 printf('%.1f%%', fg_pct) AS "FG %", printf('%.3f', pts_per_attempt) AS "Points per attempt"
FROM (SELECT BASIC_ZONE, count(*) AS attempts, round(avg(SHOT_MADE_INT) * 100, 1) AS fg_pct,
 round(avg(EXPECTED_PTS), 3) AS pts_per_attempt FROM processed GROUP BY BASIC_ZONE)""")

# ------------------------------------------------------------------ A3-A8
sql("share_fingerprint", "SELECT * FROM fp")
sql("pivot_zone_counts", "SELECT PLAYER_ID, SEASON_1, "
    + ", ".join(f"CAST(count_if(BASIC_ZONE = '{z}') AS BIGINT) AS {b}_cnt" for z, b in ZONE_TO_BASE.items())
    + " FROM processed GROUP BY PLAYER_ID, SEASON_1")
sql("top_volume", f"""SELECT PLAYER_ID, PLAYER_NAME, SEASON_1, total_attempts, {', '.join(_SHARES)}
FROM fp WHERE SEASON_1 >= {VIEW_RECENT_SEASON}
ORDER BY total_attempts DESC, PLAYER_ID, SEASON_1 LIMIT 10""")
sql("feature_means", "SELECT " + ", ".join(f"round(avg({s}), 6) AS {s}" for s in _SHARES) + " FROM fp")
sql("era_totals", "SELECT ERA, CAST(count(*) AS BIGINT) AS n FROM fp GROUP BY ERA")
sql("group_profile", "SELECT CAST(PLAYER_ID % 5 AS INT) AS cluster, CAST(count(*) AS BIGINT) AS n, "
    + ", ".join(f"round(avg({s}), 3) AS {s}" for s in _SHARES) + " FROM fp GROUP BY 1")
sql("era_shift", """SELECT cluster, pre, post,
 round(CAST(pre AS DOUBLE) / sum(pre) OVER () * 100, 1) AS pre_pct,
 round(CAST(post AS DOUBLE) / sum(post) OVER () * 100, 1) AS post_pct,
 round(round(CAST(post AS DOUBLE) / sum(post) OVER () * 100, 1)
       - round(CAST(pre AS DOUBLE) / sum(pre) OVER () * 100, 1), 1) AS delta_pct
FROM (SELECT CAST(PLAYER_ID % 5 AS INT) AS cluster,
  CAST(count_if(ERA = 'pre') AS BIGINT) AS pre, CAST(count_if(ERA = 'post') AS BIGINT) AS post
  FROM fp GROUP BY 1)""")

# ------------------------------------------------------------------ W
sql("yoy_change", "SELECT * FROM yoy")
sql("steepest_change", """SELECT * FROM yoy WHERE yoy_change IS NOT NULL
ORDER BY yoy_change DESC, SEASON_1 LIMIT 1""")
sql("endpoint_change", """SELECT first_period, first_value, last_period, last_value,
 round(last_value - first_value, 1) AS change, round(last_value / first_value, 3) AS ratio FROM (
 SELECT min(SEASON_1) AS first_period, arg_min(three_pt_rate_pct, SEASON_1) AS first_value,
  max(SEASON_1) AS last_period, arg_max(three_pt_rate_pct, SEASON_1) AS last_value FROM rates)""")
sql("entity_trend", """SELECT PLAYER_ID, SEASON_1, prev_SEASON_1, three_share_pct, yoy_change FROM (
 SELECT *, row_number() OVER (PARTITION BY PLAYER_ID ORDER BY yoy_change DESC, SEASON_1) AS r FROM (
  SELECT PLAYER_ID, SEASON_1, three_share_pct,
   lag(SEASON_1) OVER (PARTITION BY PLAYER_ID ORDER BY SEASON_1) AS prev_SEASON_1,
   round(three_share_pct - lag(three_share_pct) OVER (PARTITION BY PLAYER_ID ORDER BY SEASON_1), 1)
     AS yoy_change
  FROM (SELECT *, round((lc3_share + rc3_share + atb3_share) * 100, 1) AS three_share_pct FROM fp))
 WHERE yoy_change IS NOT NULL) WHERE r = 1""")
sql("point_lookup", f"""SELECT max(CASE WHEN SEASON_1 = {VIEW_POINT_SEASON} THEN three_pt_rate_pct END)
 AS rate_at_season FROM rates""")
sql("era_report", f"""SELECT y.SEASON_1, y.three_pt_rate_pct, y.yoy_change,
 y.SEASON_1 BETWEEN {VIEW_WINDOW[0]} AND {VIEW_WINDOW[1]} AS in_window,
 t.SEASON_1 IS NOT NULL AS is_steepest
FROM yoy y LEFT JOIN (SELECT SEASON_1 FROM yoy WHERE yoy_change IS NOT NULL
  ORDER BY yoy_change DESC, SEASON_1 LIMIT 1) t ON y.SEASON_1 = t.SEASON_1""")

# ------------------------------------------------------------------ metrics
sql("confusion", "SELECT * FROM conf")
sql("classification_metrics", """SELECT tn, fp, fn, tp,
 round(p1, 10) AS precision, round(r1, 10) AS recall, round(acc, 10) AS accuracy,
 round(coalesce(((tp + fn) * f1_1 + (tn + fp) * f1_0) / nullif(n, 0), 0), 10) AS f1_weighted
FROM (SELECT *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1_1,
   coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f1_0 FROM (
  SELECT *, tn + fp + fn + tp AS n,
   coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS p1,
   coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS r1,
   coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0) AS p0,
   coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0) AS r0,
   coalesce(CAST(tp + tn AS DOUBLE) / nullif(tn + fp + fn + tp, 0), 0) AS acc FROM conf))""")
sql("auc_exact", """SELECT round(CAST(sum(2 * pos * neg_below + pos * neg) AS DOUBLE)
   / CAST(2 * sum(pos) * sum(neg) AS DOUBLE), 10) AS auc,
 CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM (
 SELECT score, pos, neg, coalesce(sum(neg) OVER (ORDER BY score
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM (
  SELECT score, CAST(count_if(SHOT_MADE_INT = 1) AS BIGINT) AS pos,
   CAST(count_if(SHOT_MADE_INT = 0) AS BIGINT) AS neg FROM pred GROUP BY score))""")


# ------------------------------------------------------------------ features
_CATS = ["BASIC_ZONE", "SHOT_TYPE", "ZONE_RANGE", "ACTION_GROUP"]
_LVL = ("lvl AS (SELECT column_name, pos, level, n, CAST(row_number() OVER (PARTITION BY column_name "
        "ORDER BY n DESC, level) - 1 AS INT) AS level_index FROM (\n"
        + _union([f"SELECT '{c}' AS column_name, {i} AS pos, CAST({c} AS VARCHAR) AS level, "
                  f"CAST(count(*) AS BIGINT) AS n FROM pa WHERE {c} IS NOT NULL GROUP BY {c}"
                  for i, c in enumerate(_CATS)]) + "))")
_PA = f"pa AS (SELECT *, {_ACTION_GROUP} AS ACTION_GROUP FROM processed)"
sql("index_levels", f""", {_PA}, {_LVL}
SELECT column_name, level, n, level_index FROM lvl""".replace("\n, ", "", 1))
_NUMERIC_SLOTS = _union([f"SELECT {i} AS slot, '{c}' AS feature" for i, c in enumerate(_num)])
sql("feature_slots", f""", {_PA}, {_LVL},
cnt AS (SELECT column_name, pos, count(*) AS nl FROM lvl GROUP BY column_name, pos),
off AS (SELECT column_name, coalesce(sum(nl) OVER (ORDER BY pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM cnt)
SELECT CAST({len(_num)} + o + level_index AS INT) AS slot, lvl.column_name || '_ohe_' || level AS feature
FROM lvl JOIN off ON lvl.column_name = off.column_name
UNION ALL
{_NUMERIC_SLOTS}""")
sql("standardise", "SELECT PLAYER_ID, SEASON_1, " + ", ".join(
    f"round(({s} - avg({s}) OVER ()) / stddev_samp({s}) OVER (), 6) AS z_{s}" for s in _SHARES)
    + " FROM fp")
_pairs = [(a, b) for i, a in enumerate(_SHARES) for b in _SHARES[i + 1:]]
sql("feature_corr", _union([f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM fp"
                            for a, b in _pairs]))


# ------------------------------------------------------------------ W4, generic tables
sql("zone_relative_gap", """SELECT BASIC_ZONE, pts_per_attempt,
 round(pts_per_attempt / base, 3) AS ratio_to_base, round((pts_per_attempt / base - 1) * 100, 1) AS pct_vs_base
FROM (SELECT *, max(CASE WHEN BASIC_ZONE = 'Mid-Range' THEN pts_per_attempt END) OVER () AS base FROM (
 SELECT BASIC_ZONE, round(avg(EXPECTED_PTS), 3) AS pts_per_attempt FROM processed GROUP BY BASIC_ZONE))""")
ORACLE["events_breakdown"] = """SELECT event_type, n, round(CAST(n AS DOUBLE) / sum(n) OVER () * 100, 1) AS pct
FROM (SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type)"""
_EV = ["event_id", "ts", "user_id", "event_type", "value", "props"]
ORACLE["events_nulls"] = _union(
    [f"SELECT '{c}' AS column_name, 'present' AS status, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count"
     f" FROM events" for c in _EV])
ORACLE["lineitem_quantiles"] = """SELECT min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS p25,
 quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.75) AS p75, max(l_quantity) AS max
FROM lineitem"""

ORACLE["events_daily_trend"] = """SELECT event_type, day, prev_day, n, day_change FROM (
 SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day_change DESC, day) AS r FROM (
  SELECT event_type, day, n, lag(day) OVER (PARTITION BY event_type ORDER BY day) AS prev_day,
   n - lag(n) OVER (PARTITION BY event_type ORDER BY day) AS day_change
  FROM (SELECT event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n
        FROM events GROUP BY event_type, CAST(ts AS DATE)))
 WHERE day_change IS NOT NULL) WHERE r = 1"""
ORACLE["documents_breakdown"] = """SELECT lang, n, round(CAST(n AS DOUBLE) / sum(n) OVER () * 100, 1) AS pct
FROM (SELECT lang, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY lang)"""
ORACLE["orders_first_dates"] = "SELECT DISTINCT o_orderdate FROM orders ORDER BY o_orderdate LIMIT 10"

_VERIFY = """SELECT
 CASE WHEN GROUPING(BASIC_ZONE) = 0 THEN 'zone' WHEN GROUPING(SHOT_TYPE) = 0 THEN 'shot_type'
      WHEN GROUPING(SEASON_1) = 0 THEN 'season' ELSE 'all' END AS grouping,
 CASE WHEN GROUPING(BASIC_ZONE) = 0 THEN BASIC_ZONE WHEN GROUPING(SHOT_TYPE) = 0 THEN SHOT_TYPE
      WHEN GROUPING(SEASON_1) = 0 THEN CAST(SEASON_1 AS VARCHAR) END AS key,
 CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(SHOT_MADE AS INT)) AS BIGINT) AS made,
 CAST(count(SHOT_MADE) AS BIGINT) AS made_n
FROM shots GROUP BY GROUPING SETS ((BASIC_ZONE), (SHOT_TYPE), (SEASON_1), ())"""
sql("verify_one_pass", _VERIFY)
sql("verify_cells", _VERIFY)
sql("sketched_distincts", """SELECT SEASON_1, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT GAME_ID) AS BIGINT) AS n_games,
 CAST(count(DISTINCT PLAYER_ID) AS BIGINT) AS n_players, true AS games_close, true AS players_close
FROM shots GROUP BY SEASON_1""")
ORACLE["price_quantiles"] = "SELECT min(l_extendedprice) AS min, " + ", ".join(
    f"round(quantile_cont(l_extendedprice, {p}), 6) AS p{round(p * 100):02d}" for p in (0.01, 0.25, 0.5, 0.75, 0.99)) \
    + ", max(l_extendedprice) AS max FROM lineitem"

# ------------------------------------------------------------------ F4, F5
_DRAW = ("CAST('0x' || substr(md5(concat_ws('|', '42', "
         + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in ("GAME_ID", "QUARTER", "PLAYER_ID", "SECS_LEFT", "LOC_X"))
         + ")), 1, 13) AS BIGINT)")
sql("sampled_zone_efficiency", f"""SELECT BASIC_ZONE, CAST(count(*) AS BIGINT) AS attempts,
 round(avg(SHOT_MADE_INT) * 100, 1) AS fg_pct, round(avg(EXPECTED_PTS), 3) AS pts_per_attempt
FROM processed WHERE {_DRAW} < {round(0.05 * 2**52)} GROUP BY BASIC_ZONE""")
sql("split_counts", f"""SELECT CASE WHEN {_DRAW} < {round(0.8 * 2**52)} THEN 'train' ELSE 'test' END AS part, SEASON_1,
 CAST(count(*) AS BIGINT) AS n, CAST(sum(SHOT_MADE_INT) AS BIGINT) AS n_made FROM processed GROUP BY 1, 2""")


def oracle_sql() -> dict[str, str]:
    from . import io_oracle  # noqa: F401  (registration of IO / feature queries)
    return dict(ORACLE)

# ------------------------------------------------------------------ certificates of the fits
# What an engine without the optimiser can say of a fit: how many rows and slots it had, and that its
# optimality holds; the Spark side works the proof out from the fitted coefficients.
_TRAIN = f"tr AS (SELECT * FROM pa WHERE {_DRAW} < {round(0.8 * 2**52)} AND {_ok})"
_SLOTS = " + ".join([str(len(_num))] + [f"(SELECT count(DISTINCT {c}) FROM pa WHERE {_DRAW} < {round(0.8 * 2**52)})" for c in _CATS])
sql("lasso_certificate", f""", {_PA}, {_TRAIN}
SELECT CAST(p AS DOUBLE) AS "regParam", (SELECT count(*) FROM tr) AS n_rows, CAST({_SLOTS} AS INT) AS n_slots, true AS optimal
FROM (VALUES {", ".join(f"({p})" for p in LASSO_PENALTIES)}) t(p)""")
sql("svm_certificate", f""", {_PA}, {_TRAIN}
SELECT (SELECT count(*) FROM tr) AS n_rows, CAST({_SLOTS} AS INT) AS n_slots, true AS optimal""")
sql("kmeans_certificate", """SELECT CAST(count(*) AS BIGINT) AS n_points, CAST(0 AS BIGINT) AS n_nearer_elsewhere,
 true AS centres_hold FROM fp""")
sql("k_sweep_certificate", f"""SELECT CAST(k AS INT) AS k, true AS converged, CAST(n AS BIGINT) AS n_points,
 CAST(0 AS BIGINT) AS n_nearer_elsewhere, true AS centres_hold
FROM (SELECT count(*) AS n FROM fp), (VALUES {", ".join(f"({k})" for k in K_RANGE)}) t(k)""")


# ------------------------------------------------------------------ PCA
# Components of the correlation matrix one after the other: a matrix squared again and again tends to the
# projection on its first component, which is then taken off.
_D = len(_SHARES)


def _pca_ctes(n: int) -> str:
    corr = ", ".join("[" + ", ".join("1.0" if a == b else f"corr({a}, {b})" for b in _SHARES) + "]" for a in _SHARES)
    ctes = [f"m0 AS MATERIALIZED (SELECT [{corr}] AS m FROM fp)"]
    for c in range(n):
        ctes.append(f"""q{c} AS MATERIALIZED (WITH RECURSIVE s(i, m) AS (SELECT 0, m FROM m{c} UNION ALL
  SELECT i + 1, list_transform(p, lambda r: list_transform(r, lambda x: x / list_sum(list_transform(range(1, {_D + 1}), lambda t: p[t][t]))))
  FROM (SELECT i, list_transform(m, lambda r: list_transform(range(1, {_D + 1}), lambda j:
   list_sum(list_transform(range(1, {_D + 1}), lambda t: r[t] * m[t][j])))) AS p FROM s WHERE i < 24)) SELECT m FROM s WHERE i = 24)""")
        ctes.append(f"""u{c} AS (SELECT list_transform(m, lambda r: r[list_position(d, list_max(d))]) AS u
  FROM (SELECT m, list_transform(range(1, {_D + 1}), lambda t: m[t][t]) AS d FROM q{c}))""")
        ctes.append(f"""v{c} AS MATERIALIZED (SELECT list_transform(u, lambda x: x / sqrt(list_dot_product(u, u))
   * sign(u[list_position(a, list_max(a))])) AS v
  FROM (SELECT u, list_transform(u, lambda x: round(abs(x) / sqrt(list_dot_product(u, u)), 9)) AS a FROM u{c}))""")
        ctes.append(f"""e{c} AS MATERIALIZED (SELECT list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS e, v
  FROM m0, v{c})""")
        ctes.append(f"""m{c + 1} AS MATERIALIZED (SELECT list_transform(range(1, {_D + 1}), lambda a: list_transform(range(1, {_D + 1}), lambda b:
  m[a][b] - e * v[a] * v[b])) AS m FROM m{c}, e{c})""")
    return ",\n".join(ctes)


sql("pca_loadings", f", {_pca_ctes(N_PCA)}\n" + _union(
    [f"SELECT '{s}' AS feature, " + ", ".join(f"round(e{c}.v[{i + 1}], 9) AS \"PC{c + 1}\"" for c in range(N_PCA))
     + " FROM " + ", ".join(f"e{c}" for c in range(N_PCA)) for i, s in enumerate(_SHARES)]))
sql("explained_variance", f", {_pca_ctes(N_PCA)}\n" + f"""SELECT component, round(x, 9) AS explained_variance,
 round(sum(x) OVER (ORDER BY component), 9) AS cumulative FROM (""" + _union(
    [f"SELECT CAST({c + 1} AS INT) AS component, e{c}.e / {_D} AS x FROM e{c}" for c in range(N_PCA)]) + ")")


# ------------------------------------------------------------------ path operators on the screening path
def _screened(body: str) -> str:
    numeric = [f"SELECT '{c}' AS feature, coalesce(corr(CAST({c} AS DOUBLE), CAST(SHOT_MADE_INT AS DOUBLE)), 0) AS c FROM pa" for c in _num]
    levels = [f"""SELECT '{c}_ohe_' || {c} AS feature, coalesce((a * m - n * b) / nullif(sqrt(n * (a - n)) * sqrt(b * (a - b)), 0), 0) AS c
FROM (SELECT {c}, CAST(n AS DOUBLE) AS n, CAST(m AS DOUBLE) AS m, CAST(sum(n) OVER () AS DOUBLE) AS a, CAST(sum(m) OVER () AS DOUBLE) AS b
 FROM (SELECT {c}, count(*) AS n, sum(SHOT_MADE_INT) AS m FROM pa GROUP BY {c})) WHERE {c} IS NOT NULL""" for c in _CATS]
    return f""", {_PA}, one AS (SELECT feature, round(c, 9) AS c FROM ({_union(numeric + levels)})),
path AS (SELECT CAST(p AS DOUBLE) AS "regParam", feature, round(sign(c) * greatest(abs(c) - p, 0), 9) + 0.0 AS coefficient
 FROM one, (VALUES {", ".join(f"(CAST({p} AS DOUBLE))" for p in LASSO_PENALTIES)}) t(p)),
peaks AS (SELECT feature, max(abs(coefficient)) AS peak_abs,
 max(CASE WHEN coefficient <> 0 THEN "regParam" END) AS entry_param FROM path GROUP BY feature)
{body}"""


_label = "feature"
for _old, _new in LABEL_REPLACEMENTS:
    _label = f"replace({_label}, '{_old}', '{_new}')"
sql("screen_path", _screened("SELECT * FROM path"))
sql("screen_active_features", _screened('SELECT "regParam", feature FROM path WHERE coefficient <> 0'))
sql("screen_active_counts", _screened("""SELECT *, n_active - lag(n_active) OVER w AS change,
 coalesce(n_active >= lag(n_active) OVER w, true) AS non_decreasing
FROM (SELECT "regParam", CAST(count_if(coefficient <> 0) AS BIGINT) AS n_active, CAST(count(*) AS BIGINT) AS n_features
 FROM path GROUP BY 1) WINDOW w AS (ORDER BY "regParam" DESC)"""))
sql("screen_wide", _screened('SELECT "regParam", ' + ", ".join(
    f"max(CASE WHEN feature = '{c}' THEN coefficient END) AS {c}" for c in _num) + " FROM path GROUP BY 1"))
sql("screen_top_features", _screened("SELECT feature, peak_abs FROM peaks ORDER BY peak_abs DESC, feature LIMIT 8"))
sql("screen_summary", _screened("""SELECT feature, peak_abs, entry_param,
 CASE WHEN entry_param IS NOT NULL THEN CAST(dense_rank() OVER (ORDER BY entry_param DESC NULLS LAST) AS INT) END AS entry_rank,
 row_number() OVER (ORDER BY peak_abs DESC, feature) <= 8 AS in_top FROM peaks"""))
sql("screen_coef_table", _screened(f"""SELECT feature, coefficient, abs(coefficient) >= 0.02 AS kept,
 CASE WHEN starts_with(feature, '{ACTION_PREFIX}') THEN 'Action'
  WHEN feature IN ({", ".join(f"'{c}'" for c in CONTEXT_FEATURES)}) THEN 'Context' ELSE 'Location' END AS category, {_label} AS label
FROM path WHERE "regParam" = {HEADLINE_PENALTY} AND NOT regexp_matches(feature, '(?i)Back Court')"""))

# ------------------------------------------------------------------ cluster tables on a given grouping
sql("group_centroids", "SELECT CAST(PLAYER_ID % 5 AS INT) AS cluster, CAST(count(*) AS BIGINT) AS n, "
    + ", ".join(f"round(avg({s}), 6) AS {s}" for s in _SHARES) + " FROM fp GROUP BY 1")


def _named(body: str) -> str:
    """Signatures taken greedily by z-score: each round the best pair of a free name and a free group."""
    z = [f"""SELECT '{name}' AS name, cluster, (v - avg(v) OVER ()) / coalesce(nullif(stddev_samp(v) OVER (), 0), 1) AS z
FROM (SELECT cluster, {" + ".join(cols)} AS v FROM prof)""" for name, cols in ARCHETYPE_SIGNATURES]
    ctes = ["prof AS (SELECT CAST(PLAYER_ID % 5 AS INT) AS cluster, " + ", ".join(f"round(avg({s}), 3) AS {s}" for s in _SHARES)
            + " FROM fp GROUP BY 1)", f"marks AS ({_union(z)})"]
    taken = []
    for i in range(len(ARCHETYPE_SIGNATURES)):
        free = " AND ".join(f"name <> (SELECT name FROM t{j}) AND cluster <> (SELECT cluster FROM t{j})" for j in taken) or "true"
        ctes.append(f"t{i} AS MATERIALIZED (SELECT name, cluster FROM marks WHERE {free} ORDER BY z DESC, cluster, name LIMIT 1)")
        taken.append(i)
    ctes.append("named AS (" + _union([f"SELECT cluster, name AS archetype FROM t{i}" for i in taken])
                + f" UNION ALL SELECT cluster, '{VERSATILE_NAME}' FROM prof WHERE "
                + " AND ".join(f"cluster <> (SELECT cluster FROM t{i})" for i in taken) + ")")
    return ", " + ",\n".join(ctes) + "\n" + body


sql("group_names", _named("SELECT cluster, archetype FROM named"))
_era_shift = ORACLE["era_shift"].split("AS tp FROM pred)", 1)[1]
sql("group_shift", _named(f"""SELECT e.*, archetype, printf('%+.1f', delta_pct) AS delta_text, greatest(pre_pct, post_pct) AS label_at
FROM ({_era_shift}) e LEFT JOIN named USING (cluster)"""))
