"""Additive cells, exact quantiles by selection, and portable key draws."""

import contextlib
import io
import math
import random

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from shotframe.operators import cells as CE
from shotframe.operators import features as FE
from shotframe.operators import profile as Q
from shotframe.operators import quantiles as QU
from shotframe.operators import select as S
from shotframe.plans.queries import queries, shots


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def depth_of(text, word):
    """Lines of the plan with a word, by how deep they stand."""
    return [(len(line) - len(line.lstrip(" :+-*(0123456789)")), line) for line in text.splitlines() if word in line]


@pytest.mark.parametrize("name", ["index_levels", "profile_distinct", "verify_cells"])
def test_facts_are_neither_stacked_nor_expanded(spark, name):
    p = plan(queries()[name](spark, SF_SMALL))
    multiplied = [d for w in ("Expand", "Generate") for d, _ in depth_of(p, w)]
    scans = [d for d, _ in depth_of(p, "FileScan parquet")]
    assert multiplied and p.count("FileScan parquet") == 2
    # below what multiplies rows stands an exchange of cells, and the scans lie below that
    cells = [d for d, _ in depth_of(p, "Exchange hashpartitioning") if d > max(multiplied)]
    assert cells and min(cells) < min(scans)


def test_breakdown_has_no_window_over_all_values(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("v"))
    out = Q.breakdown(df, "v")
    assert "Window" not in plan(out)
    assert {r.v: (r.n, r.pct) for r in out.collect()} == {v: (143 if v < 6 else 142, 14.3 if v < 6 else 14.2) for v in range(7)}
    assert Q.breakdown(df.where("false"), "v").collect() == []
    some = Q.breakdown(spark.createDataFrame([(None,), (None,), (1,)], "v int"), "v")
    assert [tuple(r) for r in some.collect()] == [(None, 2, 66.7), (1, 1, 33.3)]


def test_cells_give_what_the_rows_give(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.choice([None, "x", "y`z"]), rng.randint(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, `odd ``name` string, m int")
    cells = CE.value_cells(df, ["k", "odd `name"], {"made": F.col("m")})
    long = {(r.column_name, r.level): r.n for r in CE.values_of_cells(cells, ["k", "odd `name"]).collect()}
    assert long == ({("k", v): sum(r[0] == v for r in rows) for v in "abc"}
                    | {("odd `name", v): sum(r[1] == v for r in rows) for v in (None, "x", "y`z")})
    prof = {(r.grouping, r.key): (r.n, r.made) for r in CE.profile_of_cells(cells, {"one": "k", "two": "odd `name"}, ["made"]).collect()}
    assert prof[("all", None)] == (500, sum(r[2] for r in rows))
    assert prof[("two", None)] == (sum(r[1] is None for r in rows), sum(r[2] for r in rows if r[1] is None))
    assert prof[("one", "a")] == (sum(r[0] == "a" for r in rows), sum(r[2] for r in rows if r[0] == "a"))
    empty = CE.value_cells(df.where("false"), ["k"], {"made": F.col("m")})
    assert CE.profile_of_cells(empty, {"one": "k"}).collect() == []
    assert [tuple(r) for r in CE.total_of_cells(empty, ["made"]).collect()] == [(0, 0)]
    counts = {r.column_name: r.n_distinct for r in Q.distinct_counts(df, ["k", "odd `name"]).collect()}
    assert counts == {"k": 3, "odd `name": 3}


def test_levels_by_frequency_then_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "v string")
    assert [(r.level, r.n, r.level_index) for r in FE.level_index(df, ["v"]).orderBy("level_index").collect()] == \
        [("b", 2, 0), ("a", 1, 1), ("c", 1, 2)]


def test_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 4).alias("a"), (F.col("id") % 3).alias("b"), (F.col("id") % 20_011).alias("v"),
                                    F.lit(None).cast("string").alias("none"))
    cells = CE.sketch_cells(df, ["a", "b"], ["v", "none"])
    assert cells.count() == 12
    one = CE.distincts_of_sketches(cells, [], ["v", "none"]).first()
    assert one.n == 60_000 and abs(one.v - 20_011) < 0.03 * 20_011 and one.none == 0


def sorted_rank(values, p):
    s = sorted(values, key=lambda v: (math.isnan(v), v))
    h = (len(s) - 1) * p
    lo, hi = s[math.floor(h)], s[math.ceil(h)]
    return lo if lo == hi else lo * (1 - (h - math.floor(h))) + hi * (h - math.floor(h))


@pytest.mark.parametrize("accuracy", [20, 50, 10_000])
def test_quantiles_of_any_spread(spark, accuracy):
    rng = random.Random(accuracy)
    for values in ([rng.gauss(0, 1) for _ in range(700)], [float(rng.randint(0, 3)) for _ in range(300)], [7.0] * 50, [1.0], [2.0, 1.0],
                   [rng.paretovariate(0.3) for _ in range(400)], [0.0] * 200 + [rng.random() for _ in range(100)],
                   [float("inf"), float("-inf"), 0.0, 1.0, -1.0]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
        probs = (0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0) if math.inf not in values else (0.0, 0.5, 1.0)
        got, whole = QU.exact_quantiles(df, "v", probs, accuracy)
        assert got == [sorted_rank(values, p) for p in probs] and whole.n == len(values)


def test_quantiles_equal_duckdb_without_a_shuffle_of_values(spark):
    df = spark.range(200_000).select((F.xxhash64("id") / 2.0**40).alias("v"))
    table = df.toPandas()
    assert len(table.v.unique()) > 199_000
    con = duckdb.connect()
    con.register("t", table)
    wanted = con.execute("SELECT quantile_cont(v, [0.001, 0.25, 0.5, 0.75, 0.999]) FROM t").fetchone()[0]
    r = Q.quantile_summary(df, "v", (0.001, 0.25, 0.5, 0.75, 0.999), exact=True).first()
    assert [r[1], r[2], r[3], r[4], r[5]] == pytest.approx(wanted, rel=1e-12)


def test_few_passes(spark, monkeypatch):
    rounds = []
    sketched = QU._sketched
    monkeypatch.setattr(QU, "_sketched", lambda *a: rounds.append(1) or sketched(*a))
    df = spark.range(300_000).select((F.xxhash64("id") % 10**9).alias("v"))
    values = sorted(r.v for r in df.collect())
    assert QU.order_statistics(df, "v", [123_456], 300_000, 1000)[123_456] == values[123_456]
    assert len(rounds) <= 4


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert tuple(Q.quantile_summary(df, "v", exact=True).first()) == (None,) * 5


def test_draws_are_whole_numbers_that_duckdb_repeats(spark):
    rows = [(i, None if i % 5 == 0 else f"s{i}|x", -i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a bigint, b string, c int")
    got = {r.a: r.d for r in df.select("a", S.key_draw(["a", "b", "c"], 7).alias("d")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest($1, recursive := true)", [[{"a": a, "b": b, "c": c} for a, b, c in rows]])
    wanted = con.execute("""SELECT a, CAST('0x' || substr(md5(concat_ws('|', '7', coalesce(CAST(a AS VARCHAR), '-'),
        coalesce(b, '-'), coalesce(CAST(c AS VARCHAR), '-'))), 1, 13) AS BIGINT) FROM t""").fetchall()
    assert got == dict(wanted)
    assert 0 <= min(got.values()) and max(got.values()) < 1 << S.DRAW_BITS
    assert abs(sum(d < S.draw_bound(0.3) for d in got.values()) - 600) < 90


def test_parts_of_a_split_are_whole_and_apart(spark):
    parts = S.key_split(spark.range(5000), ["id"], (3, 1, 1))
    ids = [{r.id for r in p.collect()} for p in parts]
    assert set.union(*ids) == set(range(5000)) and sum(map(len, ids)) == 5000
    assert abs(len(ids[0]) - 3000) < 200


def test_verify_from_cells_equals_grouping_sets_over_rows(spark):
    q = queries()
    assert sorted(map(tuple, q["verify_cells"](spark, SF_SMALL).collect()), key=str) == \
        sorted(map(tuple, q["verify_one_pass"](spark, SF_SMALL).collect()), key=str)
    assert shots(spark, SF_SMALL).count() > 0
