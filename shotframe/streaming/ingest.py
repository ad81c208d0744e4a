"""Incremental processing with Structured Streaming.

New raw CSV files (a new season, a re-delivered month) arrive in a folder;
each micro-batch is cleaned and derived exactly as the batch job does and
appended to the season-partitioned Parquet table.  The file sink's commit
log plus the checkpoint (on the shared folder) make every file land
exactly once, across restarts and lost executors.  ``availableNow``
processes everything present and stops — the batch job as a restartable
stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.derive import derive_shots
from ..operators.select import exclude_value
from ..schema import BACKCOURT, DEFAULT_COLUMNS, RAW_SHOT_SCHEMA, ShotColumns
from ..sources.files import csv_options


def processed_stream(spark: SparkSession, source_dir: str, schema: T.StructType = RAW_SHOT_SCHEMA,
                     cols: ShotColumns = DEFAULT_COLUMNS, max_files: int = 64) -> DataFrame:
    """Streaming DataFrame of processed rows from CSV files in ``source_dir``."""
    raw = (csv_options(spark.readStream).schema(schema)
           .option("maxFilesPerTrigger", max_files).csv(source_dir))
    return exclude_value(derive_shots(raw, cols), cols.zone, BACKCOURT)


def ingest(spark: SparkSession, source_dir: str, table_dir: str, checkpoint_dir: str,
           schema: T.StructType = RAW_SHOT_SCHEMA, cols: ShotColumns = DEFAULT_COLUMNS,
           available_now: bool = True, max_files: int = 64):
    """Append processed rows to ``table_dir`` partitioned by season.

    With ``available_now`` the call blocks until every file present has been
    processed and returns the finished query; otherwise it returns the
    running query (processing-time trigger of one minute).
    """
    stream = processed_stream(spark, source_dir, schema, cols, max_files)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .partitionBy(cols.season)
              .option("checkpointLocation", checkpoint_dir)
              .option("path", table_dir))
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(processingTime="1 minute").start()
