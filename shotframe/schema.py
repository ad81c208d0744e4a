"""Explicit schemas and the column binding every operator takes.

Schemas are never inferred on the hot path: inference costs a full extra
pass over CSV and is not stable across files (a season column holding only
``2003-04`` infers as a timestamp, together with ``2021-22`` as a string).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Raw shot columns (26, in file order), zone / shot-type / range domains,
# the zone -> short base mapping in its fixed order, and the action
# keyword buckets in match order (first match wins).
# ---------------------------------------------------------------------------
RAW_SHOT_FIELDS = [
    ("SEASON_1", T.IntegerType()), ("SEASON_2", T.StringType()),
    ("TEAM_ID", T.IntegerType()), ("TEAM_NAME", T.StringType()),
    ("PLAYER_ID", T.LongType()), ("PLAYER_NAME", T.StringType()),
    ("POSITION_GROUP", T.StringType()), ("POSITION", T.StringType()),
    ("GAME_DATE", T.StringType()), ("GAME_ID", T.LongType()),
    ("HOME_TEAM", T.StringType()), ("AWAY_TEAM", T.StringType()),
    ("EVENT_TYPE", T.StringType()), ("SHOT_MADE", T.BooleanType()),
    ("ACTION_TYPE", T.StringType()), ("SHOT_TYPE", T.StringType()),
    ("BASIC_ZONE", T.StringType()), ("ZONE_NAME", T.StringType()),
    ("ZONE_ABB", T.StringType()), ("ZONE_RANGE", T.StringType()),
    ("LOC_X", T.DoubleType()), ("LOC_Y", T.DoubleType()),
    ("SHOT_DISTANCE", T.IntegerType()), ("QUARTER", T.IntegerType()),
    ("MINS_LEFT", T.IntegerType()), ("SECS_LEFT", T.IntegerType()),
]
RAW_SHOT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_SHOT_FIELDS])

DERIVED_FIELDS = [
    ("SHOT_MADE_INT", T.IntegerType()), ("GAME_DATE_PARSED", T.DateType()),
    ("SECS_REMAINING", T.IntegerType()), ("IS_3PT", T.IntegerType()),
    ("SHOT_VALUE", T.IntegerType()), ("IS_CLUTCH", T.IntegerType()),
    ("EXPECTED_PTS", T.IntegerType()),
]

BACKCOURT = "Backcourt"
BACK_COURT_RANGE = "Back Court Shot"
THREE_PT_TYPE = "3PT Field Goal"
TWO_PT_TYPE = "2PT Field Goal"
ZONE_TO_BASE = {
    "Restricted Area": "rim",
    "In The Paint (Non-RA)": "paint",
    "Mid-Range": "mid",
    "Left Corner 3": "lc3",
    "Right Corner 3": "rc3",
    "Above the Break 3": "atb3",
}
THREE_PT_ZONES = ["Left Corner 3", "Right Corner 3", "Above the Break 3", "Backcourt"]
ACTION_RULES = [
    ("Dunk", ["dunk"]),
    ("Layup", ["layup"]),
    ("Hook", ["hook"]),
    ("Jump Shot", ["jump", "fade", "pullup", "pull-up", "step back", "stepback",
                   "turnaround", "floating"]),
]
ACTION_DEFAULT = "Other"
NUMERIC_FEATURES = ["LOC_X", "LOC_Y", "SHOT_DISTANCE", "SECS_REMAINING", "IS_3PT",
                    "SHOT_VALUE", "IS_CLUTCH", "QUARTER"]
CATEGORICAL_FEATURES = ["BASIC_ZONE", "SHOT_TYPE", "ZONE_RANGE", "ACTION_GROUP"]
# Label-derived columns that must never be features (leakage guard).
LEAKY_COLUMNS = ["EXPECTED_PTS", "EVENT_TYPE", "SHOT_MADE", "SHOT_MADE_INT"]
LASSO_PENALTIES = [0.05, 0.01, 0.005, 0.001, 0.0005, 0.0001]
HEADLINE_PENALTY = 0.001
K_RANGE = [3, 4, 5, 6, 7, 8]
CHOSEN_K = 5
N_PCA = 5
SEED = 42
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ShotColumns:
    """Binds the logical roles the operators use to physical column names.

    Operators take one of these instead of hard-coding names, so the same
    code runs on the reference's shot files, on the driver's shot view, or on
    any other event fact table.
    """

    season: str = "SEASON_1"
    entity: str = "PLAYER_ID"
    entity_name: str = "PLAYER_NAME"
    made: str = "SHOT_MADE"
    made_int: str = "SHOT_MADE_INT"
    zone: str = "BASIC_ZONE"
    zone_range: str = "ZONE_RANGE"
    shot_type: str = "SHOT_TYPE"
    action: str = "ACTION_TYPE"
    action_group: str = "ACTION_GROUP"
    game_date: str = "GAME_DATE"
    quarter: str = "QUARTER"
    mins_left: str = "MINS_LEFT"
    secs_left: str = "SECS_LEFT"
    zones: dict = field(default_factory=lambda: dict(ZONE_TO_BASE))
    era_split: int = 2015
    min_attempts: int = 200
    date_format: str = "MM-dd-yyyy"

    def with_(self, **kw) -> "ShotColumns":
        return replace(self, **kw)


DEFAULT_COLUMNS = ShotColumns()

# Result-table schemas (explicit, for CSV read-back and driver rows).
ZONE_TABLE_SCHEMA = T.StructType([
    T.StructField("BASIC_ZONE", T.StringType()),
    T.StructField("attempts", T.LongType()),
    T.StructField("fg_pct", T.DoubleType()),
    T.StructField("pts_per_attempt", T.DoubleType()),
])
SEASON_TABLE_SCHEMA = T.StructType([
    T.StructField("SEASON_1", T.IntegerType()),
    T.StructField("total_attempts", T.LongType()),
    T.StructField("three_pt_attempts", T.LongType()),
    T.StructField("three_pt_rate_pct", T.DoubleType()),
    T.StructField("overall_fg_pct", T.DoubleType()),
])
PATH_SCHEMA = T.StructType([
    T.StructField("regParam", T.DoubleType()),
    T.StructField("feature", T.StringType()),
    T.StructField("coefficient", T.DoubleType()),
])
