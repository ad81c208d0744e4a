"""Entry 1: raw shots -> processed, season-partitioned Parquet + two report tables.

The raw input is read once.  Every row is derived and written, into one
staged folder partitioned by outcome and season: ``kept``, ``removed`` (back
court), ``no_zone`` (a null zone) and ``malformed`` (lines with a value that
did not parse).  The accounting (Q12) is a count over that folder's partition
columns alone, which Parquet answers from the row counts in its footers.  Only
if no line is malformed does the ``kept`` folder become the table, by renames;
else the table that stood before is left as it was and the staged folder keeps
the malformed lines for inspection.

The zone and season tables come from one grouped pass over the *written*
Parquet (five columns read, columnar) through the additive cell table, which
also gives the rows per season as read back, held against the footers' (S7).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import derive_shots
from ..operators import aggregate as A
from ..schema import BACKCOURT, DEFAULT_COLUMNS, ShotColumns
from ..sources import files as IO


#: What becomes of a raw row.
KEPT, REMOVED, NO_ZONE, MALFORMED = "kept", "removed", "no_zone", "malformed"
OUTCOME = "_outcome"


@dataclass
class ProcessingResult:
    table_path: str
    n_raw: int
    n_removed: int
    n_null_zone: int
    n_written: int
    zone_table: DataFrame
    season_table: DataFrame
    per_season: DataFrame       # S7: n_written, n_expected, matches per season
    n_malformed: int            # raw lines with a value that did not parse
    n_mismatched: int           # seasons whose written rows differ from the expected ones
    published: bool             # whether table_path holds the new table
    staged_path: str | None     # where the rows lie if they were not published

    @property
    def consistent(self) -> bool:
        # rows kept by ``zone != Backcourt`` (NULL zones drop out, as in SQL)
        return (self.n_written == self.n_raw - self.n_removed - self.n_null_zone
                and not self.n_malformed and not self.n_mismatched)


def outcome_of(cols: ShotColumns, malformed: bool):
    """The outcome of a raw row: a malformed line goes first, then its zone decides."""
    zone = F.col(cols.zone)
    by_zone = F.when(zone.isNull(), NO_ZONE).when(zone == BACKCOURT, REMOVED).otherwise(KEPT)
    return F.when(F.col(IO.MALFORMED).isNotNull(), MALFORMED).otherwise(by_zone) if malformed else by_zone


def stage_rows(raw: DataFrame, path: str, cols: ShotColumns = DEFAULT_COLUMNS, rebalance: bool = True) -> None:
    """Write every raw row, derived, partitioned by outcome and season: the one pass over the raw input."""
    # Rebalance the raw rows, derive after the shuffle: it carries the raw
    # columns only, and the derivations run in the post-shuffle write tasks,
    # which AQE sizes to the advisory partition size.
    src = raw.hint("rebalance", cols.season) if rebalance else raw
    rows = derive_shots(src, cols).withColumn(OUTCOME, outcome_of(cols, IO.MALFORMED in raw.columns))
    rows.write.mode("overwrite").partitionBy(OUTCOME, cols.season).parquet(path)


def staged_counts(spark, path: str, season: str) -> DataFrame:
    """``_outcome, season, n`` of a staged folder, a row per written folder; reads no column, so footers alone."""
    return spark.read.parquet(path).groupBy(OUTCOME, season).agg(F.count(F.lit(1)).alias("n"))


def run_processing(raw: DataFrame, table_path: str, cols: ShotColumns = DEFAULT_COLUMNS,
                   tables_path: str | None = None, rebalance: bool = True) -> ProcessingResult:
    """Write the processed table and build both report tables.

    ``rebalance=False`` skips the shuffle before the write.  Use it when
    every input split already holds one season (the reference's input is one
    CSV per season): each task then writes about one file and the fact
    table is never shuffled.  For arbitrary layouts keep the default, which
    bounds the files per season directory.

    With malformed lines nothing is published: ``published`` is false, the
    report tables are not written, and ``staged_path`` holds all rows by outcome.
    """
    spark = raw.sparkSession
    staged = f"{table_path.rstrip('/')}.staged-{uuid.uuid4().hex[:12]}"
    stage_rows(raw, staged, cols, rebalance)
    season_type = raw.schema[cols.season].dataType.simpleString()
    counts = staged_counts(spark, staged, cols.season).collect() if _has_rows(spark, staged) else []
    n: dict[str, int] = {}
    for r in counts:
        n[r[OUTCOME]] = n.get(r[OUTCOME], 0) + r.n
    kept_path = f"{staged}/{OUTCOME}={KEPT}"
    if not n.get(KEPT):  # a table of no rows still has its columns
        derive_shots(raw, cols).limit(0).write.mode("overwrite").parquet(kept_path)
    published = not n.get(MALFORMED)
    if published:
        IO.publish(spark, kept_path, table_path)

    written = IO.read_table(spark, table_path if published else kept_path)
    cells = A.zone_period_cells(written, cols.zone, cols.season, "IS_3PT", "SHOT_MADE_INT",
                                "EXPECTED_PTS").cache()
    zone_t = A.efficiency_from_cells(cells, cols.zone)
    season_t = A.rate_from_cells(cells, cols.season)
    # Rows per season as read back from the table, against the footers of the write
    got = cells.groupBy(F.col(cols.season).alias("_s")).agg(F.sum("attempts").cast("long").alias("n_written"))
    want = spark.createDataFrame([(r[cols.season], r.n) for r in counts if r[OUTCOME] == KEPT],
                                 f"`{cols.season}` {season_type}, n_expected bigint")
    per_season = (want.join(got, F.col(cols.season).eqNullSafe(F.col("_s")), "full")
                  .select(F.coalesce(cols.season, "_s").alias(cols.season),
                          F.coalesce("n_written", F.lit(0)).alias("n_written"),
                          F.coalesce("n_expected", F.lit(0)).alias("n_expected"))
                  .withColumn("matches", F.col("n_written") == F.col("n_expected")).orderBy(cols.season).cache())
    n_mismatched = per_season.filter("NOT matches").count()
    n_written = cells.agg(F.sum("attempts")).first()[0] or 0
    if published:
        IO.delete_path(spark, staged)
        if tables_path:
            IO.write_small_csv(zone_t, f"{tables_path}/fg_pct_by_zone")
            IO.write_small_csv(season_t, f"{tables_path}/three_pt_rate_by_season")
    return ProcessingResult(table_path, sum(n.values()), n.get(REMOVED, 0), n.get(NO_ZONE, 0), int(n_written), zone_t,
                            season_t, per_season, n.get(MALFORMED, 0), n_mismatched, published,
                            None if published else staged)


def _has_rows(spark, path: str) -> bool:
    """Whether a staged folder has a file: a write of no rows by partition leaves none."""
    return not spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*") \
        .load(path).select("path").isEmpty()
