"""Files of differing headers, and the one-pass accounting of the processing job."""

import glob
import os

import pytest
from helpers import frame, shot

from shotframe import jobs
from shotframe.plans.processing import KEPT, MALFORMED, NO_ZONE, OUTCOME, REMOVED, run_processing
from shotframe.schema import RAW_SHOT_SCHEMA
from shotframe.session import scratch_path
from shotframe.sources import files as IO


def write_lines(spark, folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("".join(line + "\n" for line in lines))


def csv_files(spark, name, layouts):
    """One CSV file per (columns, rows) under a fresh folder."""
    path = scratch_path(spark, name)
    for i, (columns, rows) in enumerate(layouts):
        df = frame(spark, rows).select(*columns)
        lines = [",".join(columns)] + [",".join("" if v is None else str(v) for v in r) for r in df.collect()]
        write_lines(spark, path, f"part [{i}].csv", lines)
    return path


ALL = [f.name for f in RAW_SHOT_SCHEMA.fields]


def test_headers_of_every_order_and_a_missing_column(spark):
    layouts = [(ALL, [shot(GAME_ID=i, LOC_X=1.5, SHOT_DISTANCE=3) for i in range(3)]),
               (list(reversed(ALL)), [shot(GAME_ID=10 + i, LOC_X=2.5, SHOT_DISTANCE=4) for i in range(4)]),
               ([c for c in ALL if c != "ZONE_RANGE"], [shot(GAME_ID=20 + i, LOC_X=3.5) for i in range(5)])]
    path = csv_files(spark, "layouts", layouts) + "/*.csv"
    df = IO.read_csv_by_name(spark, path)
    assert df.schema == RAW_SHOT_SCHEMA
    got = {r.GAME_ID: (r.LOC_X, r.SHOT_DISTANCE, r.ZONE_RANGE) for r in df.collect()}
    assert got == ({i: (1.5, 3, "16-24 ft.") for i in range(3)} | {10 + i: (2.5, 4, "16-24 ft.") for i in range(4)}
                   | {20 + i: (3.5, 18, None) for i in range(5)})
    columns = IO.header_columns(spark, path)
    missing = [(r.column_name, r.n_files, r.position) for r in columns.where("status = 'missing'").collect()]
    assert missing == [("ZONE_RANGE", 1, None)]
    assert columns.where("status = 'present'").count() == 3 * 26 - 1


def test_unknown_columns_empty_files_and_one_line_files(spark):
    path = csv_files(spark, "odd", [(ALL, [shot(GAME_ID=1)])])
    write_lines(spark, path, "empty.csv", [])
    write_lines(spark, path, "only header.csv", ["GAME_ID,NEW COLUMN"])
    write_lines(spark, path, "bom.csv", ["﻿GAME_ID,NEW COLUMN", "7,x"])
    df = IO.read_csv_by_name(spark, path + "/*.csv")
    assert sorted(r.GAME_ID for r in df.collect()) == [1, 7]
    wide = IO.read_csv_by_name(spark, path + "/*.csv", every_column=True)
    assert wide.columns == ALL + ["NEW COLUMN"]
    assert {(r.GAME_ID, r["NEW COLUMN"]) for r in wide.collect()} == {(1, None), (7, "x")}
    extra = IO.header_columns(spark, path + "/*.csv").where("status = 'unexpected'").collect()
    assert [(r.column_name, r.n_files) for r in extra] == [("NEW COLUMN", 2)]
    nothing = IO.read_csv_by_name(spark, csv_files(spark, "none", []).rsplit("/", 1)[0] + "/odd-*/empty.csv")
    assert nothing.columns == ALL and nothing.count() == 0


def test_a_column_named_twice_is_an_error(spark):
    path = csv_files(spark, "twice", [])
    write_lines(spark, path, "a.csv", ["GAME_ID,GAME_ID", "1,2"])
    with pytest.raises(ValueError, match="named twice"):
        IO.read_csv_by_name(spark, path + "/*.csv")


def test_only_first_lines_are_read_for_headers(spark):
    path = csv_files(spark, "long", [(ALL, [shot(GAME_ID=i) for i in range(3000)]), (ALL, [shot(GAME_ID=9)])])
    found = IO.file_headers(spark, path + "/*.csv")
    assert list(found) == [tuple(ALL)] and len(found[tuple(ALL)]) == 2
    # the settings for it stay out of the caller's session
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "128m"


def test_process_reads_mixed_layouts(spark):
    layouts = [(list(reversed(ALL)), [shot(GAME_ID=i, SEASON_1=2001) for i in range(4)]),
               ([c for c in ALL if c != "ZONE_RANGE"], [shot(GAME_ID=20 + i, SEASON_1=2002) for i in range(5)])]
    table = scratch_path(spark, "table")
    res = jobs.process(spark, csv_files(spark, "mixed", layouts) + "/*.csv", table)
    assert res.consistent and res.published
    assert {(r.SEASON_1, r["count"]) for r in IO.read_table(spark, table).groupBy("SEASON_1").count().collect()} == {(2001, 4), (2002, 5)}
    assert MALFORMED not in IO.read_table(spark, table).columns and IO.MALFORMED not in IO.read_table(spark, table).columns


ROWS = ([shot(GAME_ID=i, SEASON_1=2000 + i % 3) for i in range(30)]
        + [shot(GAME_ID=90 + i, SEASON_1=2001, BASIC_ZONE="Backcourt") for i in range(4)]
        + [shot(GAME_ID=95, SEASON_1=2002, BASIC_ZONE=None)])


def test_raw_rows_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(1)
            yield r

    raw = spark.createDataFrame(spark.sparkContext.parallelize(ROWS, 3).mapPartitions(count), RAW_SHOT_SCHEMA)
    res = run_processing(raw, scratch_path(spark, "t"))
    assert seen.value == len(ROWS)
    assert (res.n_raw, res.n_removed, res.n_null_zone, res.n_written, res.n_malformed) == (35, 4, 1, 30, 0)
    assert [tuple(r) for r in res.per_season.collect()] == [(2000, 10, 10, True), (2001, 10, 10, True), (2002, 10, 10, True)]
    assert res.consistent and res.published and res.staged_path is None


def test_a_second_run_replaces_the_table_and_leaves_nothing_beside_it(spark):
    folder = scratch_path(spark, "home")
    for rows in (ROWS, ROWS[:7]):
        res = run_processing(frame(spark, rows), f"{folder}/shots")
        assert IO.read_table(spark, f"{folder}/shots").count() == res.n_written
    assert os.listdir(folder) == ["shots"]


def spoilt(spark, name):
    path = csv_files(spark, name, [(ALL, [shot(GAME_ID=i) for i in range(20)])])
    file = glob.glob(f"{glob.escape(path)}/*.csv")[0]
    lines = open(file).read().splitlines()
    cells = lines[3].split(",")
    cells[ALL.index("SEASON_1")] = "20x4"
    write_lines(spark, path, "bad.csv", [lines[0], ",".join(cells)])
    return path + "/*.csv", ",".join(cells)


def test_malformed_lines_are_held_apart_and_the_old_table_stays(spark):
    table = scratch_path(spark, "kept-table")
    run_processing(frame(spark, ROWS), table)
    path, bad = spoilt(spark, "spoilt")
    with pytest.raises(RuntimeError, match="1 malformed.*is as it was"):
        jobs.process(spark, path, table)
    assert IO.read_table(spark, table).count() == 30
    res = run_processing(IO.read_csv_by_name(spark, path, keep_malformed=True), table)
    assert not res.published and not res.consistent and res.n_written == 20
    held = spark.read.parquet(f"{res.staged_path}/{OUTCOME}={MALFORMED}").collect()
    assert [r[IO.MALFORMED] for r in held] == [bad]
    assert IO.read_table(spark, table).count() == 30


def test_outcomes_of_all_kinds_and_of_no_rows(spark):
    assert {KEPT, REMOVED, NO_ZONE, MALFORMED} == {"kept", "removed", "no_zone", "malformed"}
    for rows in ([], [shot(BASIC_ZONE="Backcourt")]):
        table = scratch_path(spark, "few")
        res = run_processing(frame(spark, rows), table)
        assert res.consistent and res.published and (res.n_raw, res.n_written) == (len(rows), 0)
        back = IO.read_table(spark, table)
        assert back.count() == 0 and "EXPECTED_PTS" in back.columns and "SEASON_1" in back.columns


def test_verify_reports_each_layout(spark):
    layouts = [(ALL, [shot(GAME_ID=i) for i in range(3)]),
               ([c for c in ALL if c != "SHOT_TYPE"], [shot(GAME_ID=20 + i, BASIC_ZONE="Backcourt") for i in range(5)])]
    tables = jobs.verify(spark, csv_files(spark, "two", layouts) + "/*.csv")
    assert tables["row_count"].first().n_rows == 8
    nulls = {r.column_name: (r.status, r.null_count) for r in tables["null_counts"].collect()}
    assert nulls["SHOT_TYPE"] == ("present", 5) and nulls["SHOT_ZONE_BASIC"] == ("missing", None)
    assert [r.column_name for r in tables["header_columns"].where("status = 'missing'").collect()] == ["SHOT_TYPE"]
    assert tuple(tables["removed_rows"].first()) == (8, 5, 3, 0)
