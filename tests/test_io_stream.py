"""Sources, sinks and the streaming ingest."""

import pytest

from conftest import SF_SMALL
from helpers import frame, shot
from shotframe.plans.queries import queries
from shotframe.schema import RAW_SHOT_SCHEMA
from shotframe.session import scratch_path
from shotframe.sources import files as IO
from shotframe.streaming import ingest as ST


def test_explicit_schema_keeps_season_text(spark):
    # a file whose SEASON_2 is only "2003-04" infers as a timestamp; the
    # explicit schema keeps it a string
    path = scratch_path(spark, "csv-one")
    frame(spark, [shot(SEASON_2="2003-04")]).coalesce(1).write.option("header", True).csv(path)
    df = IO.read_raw_csv(spark, path + "/*.csv")
    assert dict(df.dtypes)["SEASON_2"] == "string"
    assert df.first().SEASON_2 == "2003-04"
    assert df.schema == RAW_SHOT_SCHEMA


def test_csv_of_any_size_in_one_file_or_many(spark):
    import glob
    for one in (True, False):
        path = scratch_path(spark, "table")
        IO.write_small_csv(spark.range(150_000, numPartitions=3), path, one_file=one)
        assert len(glob.glob(f"{path}/part-*")) == (1 if one else 3)
        assert spark.read.option("header", True).csv(path).count() == 150_000


def test_roundtrip_counts_match(spark):
    rows = queries()["parquet_roundtrip"](spark, SF_SMALL).collect()
    assert rows and all(r.matches for r in rows)


def test_stream_ingest_exactly_once_on_restart(spark):
    src = scratch_path(spark, "stream-src")
    frame(spark, [shot(GAME_ID=i, SEASON_1=2000 + i % 3) for i in range(30)]) \
        .write.option("header", True).csv(src)
    table, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    ST.ingest(spark, src, table, ckpt)
    ST.ingest(spark, src, table, ckpt)              # restart: nothing is written twice
    out = IO.read_table(spark, table)
    assert out.count() == 30
    assert sorted(r.SEASON_1 for r in out.select("SEASON_1").distinct().collect()) == [2000, 2001, 2002]


def test_stream_ingest_picks_up_only_new_files(spark):
    src = scratch_path(spark, "stream-inc-src")
    frame(spark, [shot(GAME_ID=i, SEASON_1=2001) for i in range(10)]) \
        .write.option("header", True).csv(src + "/batch1")
    table, ckpt = scratch_path(spark, "stream-inc-out"), scratch_path(spark, "stream-inc-ckpt")
    ST.ingest(spark, src + "/*", table, ckpt)
    assert IO.read_table(spark, table).count() == 10
    # a new season arrives (one file is a backcourt shot: filtered as in the batch job)
    frame(spark, [shot(GAME_ID=100 + i, SEASON_1=2002,
                       BASIC_ZONE="Backcourt" if i == 0 else "Mid-Range") for i in range(5)]) \
        .write.option("header", True).csv(src + "/batch2")
    ST.ingest(spark, src + "/*", table, ckpt)
    out = IO.read_table(spark, table)
    counts = {r.SEASON_1: r["count"] for r in out.groupBy("SEASON_1").count().collect()}
    assert counts == {2001: 10, 2002: 4}
