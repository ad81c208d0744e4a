"""Oracle SQL for the IO and streaming queries (registered into ``oracle.ORACLE``)."""

from __future__ import annotations

from ..sources.shot_view import VIEW_COLUMN_ORDER, VIEW_POINT_SEASON
from .oracle import ORACLE, sql

sql("parquet_roundtrip", """SELECT SEASON_1, CAST(count(*) AS BIGINT) AS n_written,
 CAST(count(*) AS BIGINT) AS n_source, true AS matches FROM processed GROUP BY SEASON_1""")
sql("csv_ingest", "SELECT * FROM rates")
sql("stream_ingest", "SELECT * FROM rates")
sql("result_csv", """SELECT BASIC_ZONE, CAST(count(*) AS BIGINT) AS attempts,
 round(avg(SHOT_MADE_INT) * 100, 1) AS fg_pct, round(avg(EXPECTED_PTS), 3) AS pts_per_attempt
FROM processed GROUP BY BASIC_ZONE""")
sql("preview", """SELECT GAME_ID, QUARTER, PLAYER_ID, SEASON_1, BASIC_ZONE, SHOT_MADE_INT, EXPECTED_PTS
FROM processed ORDER BY GAME_ID, QUARTER, PLAYER_ID, SEASON_1, BASIC_ZONE, SHOT_MADE_INT, EXPECTED_PTS LIMIT 5""")
sql("stream_coverage", """SELECT concat_ws('|', SEASON_1, BASIC_ZONE) AS k,
 CAST(count(*) AS BIGINT) AS n_written, CAST(count(*) AS BIGINT) AS n_source, true AS matches
FROM processed GROUP BY 1""")

sql("csv_mixed_headers", f"""SELECT SEASON_1, CAST(count(*) AS BIGINT) AS n_rows,
 CAST(count_if(SHOT_MADE) AS BIGINT) AS n_made, sum(LOC_X) AS sum_x, CAST(sum(SHOT_DISTANCE) AS BIGINT) AS sum_distance,
 CAST(count_if(BASIC_ZONE = 'Backcourt') AS BIGINT) AS n_backcourt,
 CAST(count_if(SEASON_1 >= {VIEW_POINT_SEASON}) AS BIGINT) AS n_no_range, max(GAME_DATE) AS last_date
FROM shots GROUP BY SEASON_1""")
sql("processing_accounting", """SELECT CASE WHEN BASIC_ZONE = 'Backcourt' THEN 'removed' ELSE 'kept' END AS outcome,
 SEASON_1, CAST(count(*) AS BIGINT) AS n FROM shots GROUP BY 1, 2""")
# layout 0 is the one whose header sorts first: that of the later files, as the reversed one begins with SECS_LEFT
_names = f"(VALUES {', '.join(f'({i}, {c!r})' for i, c in enumerate(VIEW_COLUMN_ORDER))}) t(i, c)"
_range = VIEW_COLUMN_ORDER.index("ZONE_RANGE")
ORACLE["csv_header_columns"] = f"""SELECT CAST(0 AS INT) AS layout, c AS column_name,
 CASE WHEN i = {_range} THEN 'missing' ELSE 'present' END AS status,
 CAST(CASE WHEN i < {_range} THEN i WHEN i > {_range} THEN i - 1 END AS INT) AS position FROM {_names}
UNION ALL SELECT 1, c, 'present', CAST({len(VIEW_COLUMN_ORDER) - 1} - i AS INT) FROM {_names}"""

# The processed table's schema after the partitioned round trip.  DuckDB
# describes the processed CTE; types are mapped to Spark's names and the
# partition column moves to the end, as partition discovery places it.
_describe = ORACLE["derive_features"]
ORACLE["schema_table"] = f"""SELECT CAST(CASE WHEN column_name = 'SEASON_1' THEN n - 1 ELSE pos - 2 END AS INT) AS ordinal,
 column_name,
 CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
  WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DATE' THEN 'date'
  ELSE lower(column_type) END AS data_type,
 true AS nullable
FROM (SELECT *, row_number() OVER () AS pos, count(*) OVER () AS n FROM (DESCRIBE ({_describe})))"""

__all__ = ["ORACLE"]
