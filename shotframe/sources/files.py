"""Scans and sinks.

* Raw CSV is read with an explicit schema (no inference pass).  Files behind
  one glob may differ in their headers: each file's columns are bound by name.
* The processed fact table is written as Hive-partitioned Parquet after a
  ``rebalance`` on the partition key: one shuffle that bounds the number of
  files per partition directory, while AQE splits a large season into
  advisory-size files instead of one huge task.
* Result tables whose shape bounds them (zones, seasons, features, clusters) are written as one
  header CSV; for other tables the caller asks for a distributed write.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_SHOT_SCHEMA

#: Column that holds a line which did not parse by the schema.
MALFORMED = "_malformed"


def csv_options(reader, header: bool = True):
    """Options that batch and streaming readers of raw CSV share: columns bind to the header by name check."""
    return reader.option("header", header).option("mode", "PERMISSIVE").option("enforceSchema", False)


def file_headers(spark: SparkSession, path_or_glob: str) -> dict[tuple[str, ...], list[str]]:
    """The files behind a glob by the column names of their header line; files without a line are left out.

    One job with a task per file, which reads the first line and stops: the
    settings that give every file its own task belong to a session of their
    own.  The driver gets a line and a path per file, as it holds the list of
    files of any scan.
    """
    own = spark.newSession()
    for key, value in (("spark.sql.files.maxPartitionBytes", 1 << 40), ("spark.sql.files.openCostInBytes", 1 << 40),
                       ("spark.sql.execution.arrow.maxRecordsPerBatch", 1)):
        own.conf.set(key, str(value))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            file = batch.column(1)[0].as_py()
            if file in seen:
                return
            seen.add(file)
            yield batch

    lines = own.read.text(path_or_glob).select("value", F.col("_metadata.file_path").alias("file"))
    found: dict[str, str] = {}
    for r in lines.mapInArrow(first, "value string, file string").collect():
        found.setdefault(r.file, r.value)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted(found.items()):
        names = next(csv.reader([line.removeprefix("\ufeff")]), [])
        groups.setdefault(tuple(names), []).append(file)
    return groups


def _as_path(uri: str) -> str:
    """A file's URI as a path for the reader: decoded, with what a glob would read otherwise escaped."""
    path = uri if "://" in uri or urlsplit(uri).scheme else "file:" + uri
    return "".join("\\" + c if c in "\\{}[]*?" else c for c in unquote(path))


def header_columns(spark: SparkSession, path_or_glob: str, schema: T.StructType = RAW_SHOT_SCHEMA) -> DataFrame:
    """``layout, n_files, column_name, status, position``: the columns of every distinct header against ``schema``.

    ``status`` is ``present``, ``missing`` (a column of the schema that the
    header lacks; its position is null) or ``unexpected``.  Bounded by the
    distinct headers.
    """
    wanted = [f.name for f in schema.fields]
    rows = []
    for k, (names, files) in enumerate(sorted(file_headers(spark, path_or_glob).items())):
        rows += [(k, len(files), n, "present" if n in wanted else "unexpected", i) for i, n in enumerate(names)]
        rows += [(k, len(files), n, "missing", None) for n in wanted if n not in names]
    return spark.createDataFrame(rows, "layout int, n_files int, column_name string, status string, position int")


def header_schema(spark: SparkSession, path_or_glob: str, schema: T.StructType = RAW_SHOT_SCHEMA) -> T.StructType:
    """The columns that any file's header names, with the types of ``schema``; columns it lacks are strings."""
    known = {f.name: f for f in schema.fields}
    names = dict.fromkeys(n for header in file_headers(spark, path_or_glob) for n in header)
    return T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in names])


def read_csv_by_name(spark: SparkSession, path_or_glob: str, schema: T.StructType = RAW_SHOT_SCHEMA,
                     keep_malformed: bool = False, every_column: bool = False) -> DataFrame:
    """CSV files whose headers may differ in order and columns, as one table of ``schema``.

    Files are grouped by header, each group is read by a schema in its own
    order, and the groups are put together by name.  A column that a file
    lacks is null in its rows; columns that ``schema`` lacks are left out, or
    with ``every_column`` come after the others as strings.  The column
    ``_malformed`` of ``keep_malformed`` is as in ``read_raw_csv``.
    """
    groups = file_headers(spark, path_or_glob)
    known = {f.name: f for f in schema.fields}
    other = dict.fromkeys(n for header in groups for n in header if n not in known) if every_column else {}
    wanted = [*schema.fields, *(T.StructField(n, T.StringType()) for n in other)]
    tail = [T.StructField(MALFORMED, T.StringType())] if keep_malformed else []
    parts = []
    for header, files in groups.items():
        if len(set(header)) < len(header):
            raise ValueError(f"a column is named twice in the header of {files[0]}")
        own = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in header])
        df = read_raw_csv(spark, [_as_path(f) for f in files], own, keep_malformed=keep_malformed)
        parts.append(df.select(*[F.col(_quoted(f.name)) if f.name in header or f in tail else F.lit(None).cast(f.dataType).alias(f.name)
                                 for f in [*wanted, *tail]]))
    if not parts:
        return spark.createDataFrame([], T.StructType([*wanted, *tail]))
    return reduce(DataFrame.unionByName, parts)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_raw_csv(spark: SparkSession, path_or_glob: str | list[str], schema: T.StructType = RAW_SHOT_SCHEMA,
                 infer: bool = False, header: bool = True, keep_malformed: bool = False) -> DataFrame:
    """Header CSV files behind a glob, with an explicit schema.

    ``infer=True`` is an opt-in profile only: inference costs a full extra
    pass and is not stable per file.  ``keep_malformed=True`` adds the column
    ``_malformed`` with the text of every line that has a value which does
    not parse; all columns are then parsed, whatever a query reads.
    """
    reader = csv_options(spark.read, header)
    if infer:
        return reader.option("inferSchema", True).csv(path_or_glob)
    if keep_malformed:
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
    return reader.schema(schema).csv(path_or_glob)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Partitioned Parquet with partition discovery; the empty column of malformed lines is left out."""
    return spark.read.parquet(path).drop(MALFORMED)


def write_partitioned(df: DataFrame, path: str, key: str = "SEASON_1", mode: str = "overwrite",
                      rebalance: bool = True) -> None:
    """S3: Hive-partitioned Parquet by ``key``.

    ``rebalance=False`` when the input is already rebalanced by ``key``
    (e.g. the raw rows were, before the derivations).
    """
    out = df.hint("rebalance", key) if rebalance else df
    out.write.mode(mode).partitionBy(key).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system, local or distributed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a written folder, if it is there."""
    at, fs = _file_system(spark, path)
    fs.delete(at, True)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged folder in the place of ``path`` by renames; a table that stood there goes last.

    Both must lie in one file system.  A run that is lost in between leaves
    the old table under its own name or beside it, never half a table.
    """
    at, fs = _file_system(spark, path)
    new, _ = _file_system(spark, staged)
    old, _ = _file_system(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
    fs.mkdirs(at.getParent())
    stood = fs.exists(at)
    if stood and not fs.rename(at, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, at):
        raise OSError(f"cannot move {staged} to {path}")
    if stood:
        fs.delete(old, True)
    spark.catalog.refreshByPath(path)  # nothing cached of the old table may answer for the new one


def write_small_csv(df: DataFrame, path: str, one_file: bool = True, mode: str = "overwrite") -> None:
    """A result table as header CSV, in one pass.

    ``one_file`` is for tables bounded by their shape; a table that grows
    with the data is written with ``one_file=False``, by all tasks.
    """
    out = df.coalesce(1) if one_file else df
    out.write.mode(mode).option("header", True).csv(path)


def rows_to_table(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """Driver rows (model parameters, metrics) to a table with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A result table written by ``write_small_csv``."""
    return spark.read.schema(schema).option("header", True).csv(path)


def roundtrip_counts(written: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows per key in the written table vs the source (full outer, 0-filled)."""
    a = written.groupBy(key).agg(F.count(F.lit(1)).alias("n_written"))
    b = source.groupBy(key).agg(F.count(F.lit(1)).alias("n_source"))
    return (a.join(b, key, "full")
            .select(key, F.coalesce("n_written", F.lit(0)).alias("n_written"),
                    F.coalesce("n_source", F.lit(0)).alias("n_source"))
            .withColumn("matches", F.col("n_written") == F.col("n_source"))
            .orderBy(key))


def preview(df: DataFrame, order, n: int = 5) -> DataFrame:
    """The first n rows in a given order (deterministic)."""
    return df.orderBy(*order).limit(n)


def written_schema(df: DataFrame, key: str) -> T.StructType:
    """The schema of ``df`` after a partitioned write and read: the key comes last, all columns may be null."""
    fields = {f.name: T.StructField(f.name, f.dataType, True) for f in df.schema.fields}
    return T.StructType([*(f for n, f in fields.items() if n != key), fields[key]])


def schema_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """(ordinal, column_name, data_type, nullable); bounded by the column count, reads no row."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema.fields)]
    return rows_to_table(spark, rows, T.StructType([
        T.StructField("ordinal", T.IntegerType()), T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()), T.StructField("nullable", T.BooleanType())]))
