"""Additive cells: one map-side aggregate over the facts, everything else over its rows.

A cell holds the counts and sums of one combination of column values.  Values
per column, level orders, breakdowns and grouping sets are then small
aggregates of cells, so the fact rows are neither stacked nor expanded and go
through one partial aggregate whatever the number of columns asked about.
Cells suit columns of bounded domains; a column of an unbounded domain would
make as many cells as rows, and is carried as a mergeable sketch instead.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows per cell.
N = "n"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def value_cells(df: DataFrame, columns: Iterable[str], sums: dict[str, Column] | None = None) -> DataFrame:
    """One row per combination of ``columns``: ``n`` and the sums of whole numbers named in ``sums``."""
    return df.groupBy(*[F.col(quoted(c)) for c in columns]).agg(
        F.count(F.lit(1)).alias(N), *[F.sum(x).cast("long").alias(k) for k, x in (sums or {}).items()])


def values_of_cells(cells: DataFrame, columns: Iterable[str], sums: Iterable[str] = ()) -> DataFrame:
    """``column_name, level, n`` and the sums: rows per value (as text, null included) of each column."""
    columns = list(columns)
    parts = ", ".join(f"{literal(c)}, CAST({quoted(c)} AS STRING)" for c in columns)
    stacked = cells.select(N, *sums, F.expr(f"stack({len(columns)}, {parts}) AS (column_name, level)"))
    return stacked.groupBy("column_name", "level").agg(*[F.sum(s).alias(s) for s in (N, *sums)])


def profile_of_cells(cells: DataFrame, dims: dict[str, str], sums: Iterable[str] = ()) -> DataFrame:
    """``grouping, key, n`` and the sums, per value of each dimension and for ``all`` rows.

    Grouping sets over the cells: Expand multiplies cells, not facts.  No cells
    give no rows; ``total_of_cells`` always has its one.
    """
    labels, columns, sums = list(dims), list(dims.values()), list(sums)
    full = (1 << len(columns)) - 1
    g = (cells.groupingSets([[F.col(quoted(c))] for c in columns] + [[]], *[F.col(quoted(c)) for c in columns])
         .agg(F.coalesce(F.sum(N), F.lit(0)).alias(N), *[F.sum(s).alias(s) for s in sums], F.grouping_id().alias("_gid")))
    label, key = F.lit("all"), F.lit(None).cast("string")
    for i, (name, c) in enumerate(zip(labels, columns)):
        own = F.col("_gid") == full - (1 << (len(columns) - 1 - i))
        label, key = F.when(own, F.lit(name)).otherwise(label), F.when(own, F.col(quoted(c)).cast("string")).otherwise(key)
    return g.select(label.alias("grouping"), key.alias("key"), N, *sums)


def total_of_cells(cells: DataFrame, sums: Iterable[str] = ()) -> DataFrame:
    """One row: ``n`` and the sums over all cells, 0 where there are none."""
    return cells.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in (N, *sums)])


def sketch_cells(df: DataFrame, by: Iterable[str], columns: Iterable[str], lg_k: int = 14) -> DataFrame:
    """Per combination of ``by``: ``n`` and a distinct-count sketch of each column, of bounded size."""
    return df.groupBy(*[F.col(quoted(c)) for c in by]).agg(
        F.count(F.lit(1)).alias(N), *[F.hll_sketch_agg(F.col(quoted(c)).cast("string"), lg_k).alias(c) for c in columns])


def distincts_of_sketches(cells: DataFrame, by: Iterable[str], columns: Iterable[str]) -> DataFrame:
    """``n`` and the estimated distinct values of each column, per combination of ``by`` (a subset of the cells')."""
    return cells.groupBy(*[F.col(quoted(c)) for c in by]).agg(
        F.sum(N).alias(N), *[F.hll_sketch_estimate(F.hll_union_agg(F.col(quoted(c)))).alias(c) for c in columns])
