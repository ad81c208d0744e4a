"""Cases that once gave wrong or layout-dependent results."""

import glob

import pytest
from helpers import frame, shot
from pyspark.sql import functions as F

from shotframe import jobs
from shotframe.operators import evaluate as E
from shotframe.operators import profile as Q
from shotframe.operators import select as S
from shotframe.plans.processing import run_processing
from shotframe.session import scratch_path
from shotframe.sources import files as IO
from shotframe.streaming import ingest as ST


def test_auc_leaves_out_null_scores_and_labels(spark):
    clean = [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.3), (0, 0.2), (0, 0.1)]
    odd = [(0, None), (0, None), (0, None), (1, None), (None, 0.5)]
    for rows in (clean, clean + odd):
        r = E.auc_rank(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()
        assert (r.auc, r.n_pos, r.n_neg) == (1.0, 3, 3)


def test_auc_with_many_more_scores_than_a_bucket_holds(spark, monkeypatch):
    monkeypatch.setattr(E, "ROWS_PER_BUCKET", 50)
    df = spark.range(3000).select((F.xxhash64("id") % 2 == 0).cast("int").alias("y"), (F.xxhash64(F.col("id") + 7) % 1500 / 10.0).alias("s"))
    rows = df.collect()
    pos, neg = [r.s for r in rows if r.y == 1], [r.s for r in rows if r.y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(E.auc_rank(df, "y", "s").first().auc - want) < 1e-9


def test_tiny_fractions(spark):
    df = spark.range(4_000_000)
    for fraction in (2.5e-6, 1e-5):
        n, want = S.key_sample(df, ["id"], fraction).count(), fraction * 4_000_000
        assert abs(n - want) <= 4 * want**0.5 + 1


def test_split_is_the_same_for_any_layout(spark):
    ids = []
    for n in (4, 8):
        test = S.key_split(spark.range(0, 20_000, numPartitions=n), ["id"], (0.8, 0.2))[1]
        ids.append({r.id for r in test.collect()})
    assert ids[0] == ids[1] and abs(len(ids[0]) - 4000) < 300


def test_distinct_counts_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert [r.n_distinct for r in Q.distinct_counts(df, ["a", "b"]).collect()] == [0, 0]


def test_stream_binds_columns_by_header(spark):
    src = scratch_path(spark, "swapped")
    df = frame(spark, [shot(GAME_ID=i, MINS_LEFT=3, SECS_LEFT=40) for i in range(5)])
    names = ["SECS_LEFT" if c == "MINS_LEFT" else "MINS_LEFT" if c == "SECS_LEFT" else c for c in df.columns]
    df.select(*names).coalesce(1).write.option("header", True).csv(src)
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE|schema"):
        ST.ingest(spark, src, scratch_path(spark, "out"), scratch_path(spark, "ckpt"))


def raw_csv(spark, rows, name, edit=lambda lines: lines):
    path = scratch_path(spark, name)
    frame(spark, rows).coalesce(1).write.option("header", True).csv(path)
    file = glob.glob(f"{path}/part-*")[0]
    lines = edit(open(file).read().splitlines())
    fresh = scratch_path(spark, name)
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(fresh)
    return fresh + "/part-*"


def test_malformed_lines_are_counted(spark):
    def spoil(lines):
        at = lines[0].split(",").index("SEASON_1")
        out = [lines[0]]
        for k, line in enumerate(lines[1:]):
            cells = line.split(",")
            if k < 10:
                cells[at] = "20x4"
            out.append(",".join(cells))
        return out

    path = raw_csv(spark, [shot(GAME_ID=i) for i in range(50)], "spoilt", spoil)
    res = run_processing(IO.read_raw_csv(spark, path, keep_malformed=True), scratch_path(spark, "t"))
    assert res.n_malformed == 10 and not res.consistent
    with pytest.raises(RuntimeError, match="10 malformed"):
        jobs.process(spark, path, scratch_path(spark, "t"))


def test_processing_compares_each_season(spark):
    rows = [shot(GAME_ID=i, SEASON_1=2000 + i % 3) for i in range(30)] + [shot(GAME_ID=99, SEASON_1=2000, BASIC_ZONE="Backcourt")]
    res = run_processing(frame(spark, rows), scratch_path(spark, "t"))
    got = [(r.SEASON_1, r.n_written, r.n_expected, r.matches) for r in res.per_season.collect()]
    assert got == [(2000, 10, 10, True), (2001, 10, 10, True), (2002, 10, 10, True)]
    assert res.consistent and (res.n_raw, res.n_removed, res.n_malformed) == (31, 1, 0)


def test_verify_reports_a_missing_column(spark):
    def rename(lines):
        return [lines[0].replace("SHOT_MADE", "SHOT_MADE_FLAG"), *lines[1:]]

    path = raw_csv(spark, [shot(GAME_ID=i) for i in range(20)], "renamed", rename)
    tables = jobs.verify(spark, path)
    status = {r.column_name: r.status for r in tables["null_counts"].collect()}
    assert status["SHOT_MADE"] == "missing" and status["SHOT_MADE_FLAG"] == "present"
    assert tables["row_count"].first().n_rows == 20
    assert "zone_sanity" not in tables and "shot_type_breakdown" in tables
