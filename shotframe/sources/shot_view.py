"""The shot view: binds the shot operators to the driver's TPC-H-style tables.

The driver tables hold no basketball shots, so a deterministic view over
``lineitem JOIN supplier`` plays the raw shot table (17 of the 26 raw
columns; the other nine are never computed on).  Player = supplier,
season = ship year, era cut 1998, minimum support 20 attempts.  The same
text runs in DuckDB (see ``shotframe.plans.oracle``), so every SQL-shaped
operator can be checked row for row.

Scale notes: only six lineitem columns are read (column pruning reaches the
Parquet scan).  The supplier join is a plain equi-join with no hint: Spark
broadcasts supplier only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time), and
falls back to a sort-merge join — with AQE skew-join splitting of a hot
supplier — when the dimension is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DEFAULT_COLUMNS

# Binding of the operators' parameters to this view.
VIEW_COLUMNS = DEFAULT_COLUMNS.with_(era_split=1998, min_attempts=20)
VIEW_RECENT_SEASON = 2000
VIEW_WINDOW = (1997, 1999)
VIEW_POINT_SEASON = 1998

# Expression texts shared by both engines (fixed values of the view).
_U = "CAST((l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 1000 AS INT)"
# floor(n / 14) of a non-negative integer: double division is exact here
# (the quotient of two integers below 2^48 never rounds across an integer),
# and much cheaper than the decimal division ``/ 14.0`` would be.
_DIST = ("CAST(floor(CAST(l_quantity AS INT) * (4 + 2*(l_suppkey % 5)) / 14) AS INT)"
         " + CAST(year(l_shipdate) AS INT) - 1995")
_ZONE = ("CASE WHEN u >= 997 THEN 'Backcourt' WHEN dist < 5 THEN 'Restricted Area' "
         "WHEN dist < 10 THEN 'In The Paint (Non-RA)' WHEN dist < 22 THEN 'Mid-Range' "
         "WHEN l_partkey % 10 = 0 THEN 'Left Corner 3' WHEN l_partkey % 10 = 1 THEN 'Right Corner 3' "
         "ELSE 'Above the Break 3' END")
_ACTION = ("CASE WHEN dist < 5 THEN CASE WHEN l_partkey % 3 = 0 THEN 'Driving Dunk Shot' "
           "ELSE 'Driving Layup Shot' END "
           "WHEN dist < 10 THEN CASE WHEN l_partkey % 3 = 0 THEN 'Turnaround Hook Shot' "
           "ELSE 'Floating Jump shot' END "
           "WHEN l_partkey % 20 = 7 THEN 'Tip Shot' WHEN l_partkey % 2 = 0 THEN 'Step Back Jump shot' "
           "ELSE 'Jump Shot' END")
_MADE = "(u < 640 - 8*dist + CASE WHEN action = 'Driving Dunk Shot' THEN 280 ELSE 0 END)"
_SHOT_TYPE = ("CASE WHEN zone IN ('Left Corner 3','Right Corner 3','Above the Break 3','Backcourt') "
              "THEN '3PT Field Goal' ELSE '2PT Field Goal' END")
_RANGE = ("CASE WHEN zone='Backcourt' THEN 'Back Court Shot' WHEN dist < 8 THEN 'Less Than 8 ft.' "
          "WHEN dist < 16 THEN '8-16 ft.' WHEN dist < 24 THEN '16-24 ft.' ELSE '24+ ft.' END")

VIEW_COLUMN_ORDER = [
    "SEASON_1", "PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "GAME_ID", "GAME_DATE", "SHOT_MADE",
    "ACTION_TYPE", "SHOT_TYPE", "BASIC_ZONE", "ZONE_RANGE", "LOC_X", "LOC_Y", "SHOT_DISTANCE",
    "QUARTER", "MINS_LEFT", "SECS_LEFT",
]


def shot_view_from(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Raw shot rows (17 columns) from lineitem and supplier DataFrames."""
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         "l_shipdate", "l_quantity")
    su = supplier.select("s_suppkey", "s_name", "s_nationkey")
    b = (li.join(su, li.l_suppkey == su.s_suppkey, "inner")
         .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                 "s_name", "s_nationkey",
                 F.expr("CAST(year(l_shipdate) AS INT)").alias("season"),
                 F.expr(_U).alias("u"), F.expr(_DIST).alias("dist")))
    z = b.select("*", F.expr(_ZONE).alias("zone"), F.expr(_ACTION).alias("action"))
    return z.select(
        F.col("season").alias("SEASON_1"),
        F.col("l_suppkey").alias("PLAYER_ID"),
        F.col("s_name").alias("PLAYER_NAME"),
        F.col("s_nationkey").cast("int").alias("TEAM_ID"),
        F.col("l_orderkey").alias("GAME_ID"),
        F.date_format("l_shipdate", "MM-dd-yyyy").alias("GAME_DATE"),
        F.expr(_MADE).alias("SHOT_MADE"),
        F.col("action").alias("ACTION_TYPE"),
        F.expr(_SHOT_TYPE).alias("SHOT_TYPE"),
        F.col("zone").alias("BASIC_ZONE"),
        F.expr(_RANGE).alias("ZONE_RANGE"),
        F.expr("CAST((u % 51) - 25 AS DOUBLE)").alias("LOC_X"),
        F.col("dist").cast("double").alias("LOC_Y"),
        F.col("dist").alias("SHOT_DISTANCE"),
        F.col("l_linenumber").alias("QUARTER"),
        F.expr("CAST(l_orderkey % 12 AS INT)").alias("MINS_LEFT"),
        F.expr("CAST(l_partkey % 60 AS INT)").alias("SECS_LEFT"),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shot_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw shot view over ``{sf_dir}/lineitem.parquet`` and ``supplier.parquet``."""
    return shot_view_from(read_table(spark, sf_dir, "lineitem"),
                          read_table(spark, sf_dir, "supplier"))


# DuckDB text of the same view (only the date formatter differs).
def duckdb_view_sql() -> str:
    return f"""b AS (
 SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_quantity,
  s.s_name, s.s_nationkey,
  CAST(year(l.l_shipdate) AS INT) AS season,
  {_U} AS u,
  {_DIST} AS dist
 FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
z AS (SELECT *, {_ZONE} AS zone, {_ACTION} AS action FROM b),
shots AS (
 SELECT season AS SEASON_1, l_suppkey AS PLAYER_ID, s_name AS PLAYER_NAME,
  CAST(s_nationkey AS INT) AS TEAM_ID, l_orderkey AS GAME_ID,
  strftime(l_shipdate, '%m-%d-%Y') AS GAME_DATE,
  {_MADE} AS SHOT_MADE,
  action AS ACTION_TYPE,
  {_SHOT_TYPE} AS SHOT_TYPE,
  zone AS BASIC_ZONE,
  {_RANGE} AS ZONE_RANGE,
  CAST((u % 51) - 25 AS DOUBLE) AS LOC_X, CAST(dist AS DOUBLE) AS LOC_Y, dist AS SHOT_DISTANCE,
  l_linenumber AS QUARTER, CAST(l_orderkey % 12 AS INT) AS MINS_LEFT,
  CAST(l_partkey % 60 AS INT) AS SECS_LEFT
 FROM z)"""
