"""Verification and profiling (Q1-Q17).

Each check is one aggregate pass returning a small table; nothing is printed
and nothing is collected.  Wide one-row results are turned long with
``stack`` (a projection over the one aggregated row), so the output has one
row per checked column whatever the table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import cells as CE
from . import quantiles as QU
from .aggregate import pct
from .cells import literal as _sql_str
from .cells import quoted as _q


def row_and_column_count(df: DataFrame) -> DataFrame:
    """Q1: n_rows and n_columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """Q2 + Q3: NULL count per requested column, in one pass.

    Output (column_name, status, null_count).  A requested column that the
    table does not have gives status ``missing`` and a NULL count — it is
    reported, never skipped silently.
    """
    columns = list(columns or df.columns)
    present = [c for c in columns if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(_q(c)).isNull()).alias(f"n{i}")
                      for i, c in enumerate(present)]) if present else None
    parts = []
    idx = {c: i for i, c in enumerate(present)}
    for c in columns:
        if c in idx:
            parts.append(f"{_sql_str(c)}, 'present', n{idx[c]}")
        else:
            parts.append(f"{_sql_str(c)}, 'missing', CAST(NULL AS BIGINT)")
    stack = f"stack({len(parts)}, {', '.join(parts)}) AS (column_name, status, null_count)"
    base = counts if counts is not None else df.sparkSession.range(1)
    return base.select(F.expr(stack))


def find_column(df: DataFrame, needles=("SEASON", "YEAR")) -> str | None:
    """Q4: first column whose upper-cased name contains one of the needles."""
    for c in df.columns:
        if any(n in c.upper() for n in needles):
            return c
    return None


def coverage(df: DataFrame, key: str | None = None) -> DataFrame:
    """Q5: rows per key (discovered by name when not given), ascending."""
    key = key or find_column(df)
    if key is None:
        raise ValueError("no season/year column found; pass key=")
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(key)


def first_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Q6: the n smallest distinct values of ``col`` (a top-k: the limit is the feature)."""
    return df.select(col).distinct().orderBy(col).limit(n)


def breakdown(df: DataFrame, col: str, digits: int = 1, top: int | None = None) -> DataFrame:
    """Q7 + Q8: rows per value with the share of the total, count descending.

    The total is a scalar of the same aggregate (its exchange is planned once
    and reused), so no task sees all values, however many there are.
    """
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    out = g.withColumn("pct", pct(F.col("n"), g.agg(F.sum("n")).scalar(), digits))
    out = out.orderBy(F.desc("n"), F.asc(col))
    return out.limit(top) if top else out


def distinct_counts(df: DataFrame, columns, exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """Q11: distinct values per column, NULL counted as a value (like ``distinct().count()``).

    Exact counting goes over the cells of all columns together: the facts
    are aggregated once by combination, and the distinct values are counted
    among the cells.  Give columns of unbounded domains in calls of their own,
    or ``exact=False``: HyperLogLog++ (``approx_count_distinct``) with fixed
    memory per column, from the facts.
    """
    columns = list(columns)
    # the condition holds for every cell; without it the optimiser, to which the cells are a mere
    # DISTINCT below distinct counts, would drop them and expand the facts
    src = CE.value_cells(df, columns).where(F.col(CE.N) > 0) if exact else df

    def nd(c):
        return F.count_distinct(F.col(_q(c))) if exact else F.approx_count_distinct(F.col(_q(c)), rsd)
    aggs = [(nd(c) + F.coalesce(F.max(F.col(_q(c)).isNull().cast("int")), F.lit(0))).cast("long")
            .alias(f"n{i}") for i, c in enumerate(columns)]
    parts = ", ".join(f"{_sql_str(c)}, n{i}" for i, c in enumerate(columns))
    return src.agg(*aggs).select(
        F.expr(f"stack({len(columns)}, {parts}) AS (column_name, n_distinct)"))


def filter_accounting(df: DataFrame, col: str, value) -> DataFrame:
    """Q12: rows, rows equal to ``value`` (removed), rows kept by ``col != value``, NULLs."""
    c = F.col(col)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(c == value).alias("n_removed"),
                  F.count_if(c != value).alias("n_kept"),
                  F.count_if(c.isNull()).alias("n_null"))


def sum_invariant(df: DataFrame, columns, name: str = "share_sum") -> DataFrame:
    """Q13: min and max over rows of the row-wise sum of ``columns``."""
    from ..functions.derive import row_sum
    s = row_sum(columns)
    return df.agg(F.min(s).alias(f"{name}_min"), F.max(s).alias(f"{name}_max"),
                  F.count(F.lit(1)).alias("n_groups"))


def quantile_summary(df: DataFrame, col: str, probs=(0.25, 0.5, 0.75),
                     exact: bool = False, accuracy: int = 10000, digits: int | None = None) -> DataFrame:
    """Q14: min, quantiles, max of ``col``.

    The default is ``percentile_approx`` in one pass.  ``exact=True`` finds
    the exact quantiles (linear interpolation, like ``quantile_cont``) by
    distributed selection (``quantiles.py``): a few passes, bounded memory and
    no shuffle whatever the number of distinct values.
    """
    names = [f"p{int(round(p * 100)):02d}" for p in probs]
    c = F.col(_q(col))
    if not exact:
        qs = [F.percentile_approx(c, p, accuracy).cast("double").alias(n) for p, n in zip(probs, names)]
        return df.agg(F.min(c).alias("min"), *qs, F.max(c).alias("max"))
    values, whole = QU.exact_quantiles(df, col, probs, accuracy)
    if digits is not None:
        values = [None if v is None else round(v, digits) for v in values]
    kind = df.select(c).schema[0].dataType
    schema = T.StructType([T.StructField("min", kind), *(T.StructField(n, T.DoubleType()) for n in names),
                           T.StructField("max", kind)])
    return df.sparkSession.createDataFrame([(whole["min"], *values, whole["max"])], schema)


def crosstab_consistency(df: DataFrame, a: str, b: str, a_values, b_value) -> DataFrame:
    """Q16: rows per (a, b) and whether the pair agrees with the rule
    ``a in a_values  <=>  b == b_value``."""
    g = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    rule = F.col(a).isin(list(a_values)) == (F.col(b) == b_value)
    return g.withColumn("consistent", rule).orderBy(a, b)


def usable_rows(df: DataFrame, numeric_cols) -> DataFrame:
    """Q17: rows a skip-invalid assembler keeps (no NULL/NaN numeric feature)."""
    ok = None
    for c in numeric_cols:
        x = F.col(c).cast("double")
        cond = x.isNotNull() & ~F.isnan(x)
        ok = cond if ok is None else ok & cond
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).alias("n_usable")) \
        .withColumn("n_skipped", F.col("n_rows") - F.col("n_usable"))


def one_pass_profile(df: DataFrame, dims: dict, made: str | None = None, null_cols=(),
                     accounting: tuple | None = None) -> DataFrame:
    """Several profiles from ONE scan: grouping sets over each dimension and
    the grand total.

    ``dims`` maps a label to a column (e.g. {"zone": "BASIC_ZONE", "season":
    "SEASON_1"}).  The result has one row per value of each dimension plus
    one ``all`` row: (grouping, key, n[, made, made_n], null__<col>...,
    [n_removed, n_kept, n_null]).  Rows of a dimension give its breakdown,
    coverage or efficiency table; the ``all`` row gives row count, NULL
    counts and filter accounting.  Spark plans it as Expand -> partial
    aggregate -> one exchange of pre-aggregated rows, so a verification job
    parses raw CSV once instead of once per check.
    """
    labels = list(dims)
    cols = [dims[k] for k in labels]
    k = len(cols)
    aggs = [F.count(F.lit(1)).alias("n")]
    if made:
        m = F.col(made).cast("int")
        aggs += [F.sum(m).cast("long").alias("made"), F.count(m).alias("made_n")]
    aggs += [F.count_if(F.col(_q(c)).isNull()).alias(f"null__{c}")
             for c in null_cols if c in df.columns]
    if accounting:
        col, value = accounting
        c = F.col(col)
        aggs += [F.count_if(c == value).alias("n_removed"), F.count_if(c != value).alias("n_kept"),
                 F.count_if(c.isNull()).alias("n_null")]
    g = df.groupingSets([[c] for c in cols] + [[]], *cols).agg(*aggs, F.grouping_id().alias("_gid"))
    full = (1 << k) - 1
    label, key = F.lit("all"), F.lit(None).cast("string")
    for i, (lab, c) in enumerate(zip(labels, cols)):
        gid = full - (1 << (k - 1 - i))
        label = F.when(F.col("_gid") == gid, F.lit(lab)).otherwise(label)
        key = F.when(F.col("_gid") == gid, F.col(c).cast("string")).otherwise(key)
    rest = [x for x in g.columns if x not in cols and x != "_gid"]
    return g.select(label.alias("grouping"), key.alias("key"), *rest)
