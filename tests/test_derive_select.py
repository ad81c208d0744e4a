"""P and F families on hand-written edge rows."""

import pytest
from pyspark.sql import functions as F

from helpers import as_dicts, frame, shot
from shotframe.functions import derive as D
from shotframe.functions import text as X
from shotframe.operators import select as S


def test_derive_flags_and_values(spark):
    rows = [
        shot(GAME_ID=1, QUARTER=4, MINS_LEFT=2, SECS_LEFT=0, SHOT_TYPE="3PT Field Goal", SHOT_MADE=True),
        shot(GAME_ID=2, QUARTER=4, MINS_LEFT=2, SECS_LEFT=1, SHOT_MADE=False),
        shot(GAME_ID=3, QUARTER=5, MINS_LEFT=1, SECS_LEFT=0),
        shot(GAME_ID=4, QUARTER=3, MINS_LEFT=0, SECS_LEFT=10),
        shot(GAME_ID=5, SHOT_TYPE=None, SHOT_MADE=None),
    ]
    out = {d["GAME_ID"]: d for d in as_dicts(D.derive_shots(frame(spark, rows)))}
    assert out[1]["SECS_REMAINING"] == 120 and out[1]["IS_CLUTCH"] == 1
    assert out[1]["IS_3PT"] == 1 and out[1]["SHOT_VALUE"] == 3 and out[1]["EXPECTED_PTS"] == 3
    assert out[2]["SECS_REMAINING"] == 121 and out[2]["IS_CLUTCH"] == 0
    assert out[2]["EXPECTED_PTS"] == 0
    assert out[3]["IS_CLUTCH"] == 1          # overtime counts
    assert out[4]["IS_CLUTCH"] == 0          # third quarter never
    # NULL shot type: flag 0, value 2 (a NULL condition falls to otherwise)
    assert out[5]["IS_3PT"] == 0 and out[5]["SHOT_VALUE"] == 2
    assert out[5]["SHOT_MADE_INT"] is None and out[5]["EXPECTED_PTS"] is None


def test_bad_dates_become_null_not_errors(spark):
    rows = [shot(GAME_ID=1, GAME_DATE="04-10-2022"), shot(GAME_ID=2, GAME_DATE="2022-04-10"),
            shot(GAME_ID=3, GAME_DATE="13-40-2022"), shot(GAME_ID=4, GAME_DATE="")]
    out = {d["GAME_ID"]: d["GAME_DATE_PARSED"] for d in as_dicts(D.derive_shots(frame(spark, rows)))}
    assert str(out[1]) == "2022-04-10"
    assert out[2] is None and out[3] is None and out[4] is None


@pytest.mark.parametrize("action,group", [
    ("Turnaround Hook Shot", "Hook"), ("Driving Dunk Shot", "Dunk"),
    ("Step Back Jump shot", "Jump Shot"), ("Pull-Up Bank shot", "Jump Shot"),
    ("Tip Shot", "Other"), ("DRIVING LAYUP SHOT", "Layup"), ("turnaround fadeaway", "Jump Shot"),
    ("Floating Bank shot", "Jump Shot"), ("Putback", "Other"), (None, "Other"),
])
def test_action_buckets(spark, action, group):
    df = D.add_action_group(frame(spark, [shot(ACTION_TYPE=action)]))
    assert df.first()["ACTION_GROUP"] == group


def test_exclude_drops_nulls_unless_asked(spark):
    rows = [shot(GAME_ID=1, BASIC_ZONE="Backcourt"), shot(GAME_ID=2, BASIC_ZONE=None),
            shot(GAME_ID=3, BASIC_ZONE="Mid-Range")]
    df = frame(spark, rows)
    assert [r.GAME_ID for r in S.exclude_value(df, "BASIC_ZONE", "Backcourt").collect()] == [3]
    kept = sorted(r.GAME_ID for r in S.exclude_value(df, "BASIC_ZONE", "Backcourt", keep_nulls=True).collect())
    assert kept == [2, 3]


def test_era_label_and_shares(spark):
    df = spark.createDataFrame([(2014, 3, 0), (2015, 1, 4), (None, 0, 0)], "s int, a long, t long")
    out = df.select(D.era_label("s", [2015], ["pre", "post"]).alias("e"),
                    D.share("a", "t").alias("sh")).collect()
    assert [r.e for r in out] == ["pre", "post", "pre"]
    assert out[0].sh is None and out[1].sh == 0.25 and out[2].sh is None
    three = df.select(D.era_label("s", [2010, 2015], ["a", "b", "c"]).alias("e")).collect()
    assert [r.e for r in three] == ["b", "c", "a"]
    with pytest.raises(ValueError):
        D.era_label("s", [1, 2], ["x"])


def test_key_split_is_partition_invariant(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a = [sorted(r.k for r in p.collect()) for p in S.key_split(df.repartition(1), ["k"], [0.8, 0.2])]
    b = [sorted(r.k for r in p.collect()) for p in S.key_split(df.repartition(16), ["k"], [0.8, 0.2])]
    assert a == b
    assert len(a[0]) + len(a[1]) == 2000 and not set(a[0]) & set(a[1])
    assert 1450 < len(a[0]) < 1750


def test_regex_and_magnitude(spark):
    df = spark.createDataFrame([("ZONE_RANGE_ohe_Back Court Shot", -1.3), ("LOC_Y", -0.0004),
                                ("ACTION_GROUP_ohe_Dunk", 1.9)], "feature string, coefficient double")
    kept = S.regex_exclude(df, "feature", ["back court"])
    assert kept.count() == 2
    flags = {r.feature: r.kept for r in S.magnitude_flag(kept, "coefficient", 0.02).collect()}
    assert flags == {"LOC_Y": False, "ACTION_GROUP_ohe_Dunk": True}


def test_text_shaping(spark):
    df = spark.createDataFrame([(1344005, 61.6, 1.232, 27.7, -2.3)],
                               "n long, p double, x double, d1 double, d2 double")
    r = df.select(X.thousands("n").alias("a"), X.percent_text("p").alias("b"),
                  X.fixed("x", 3).alias("c"), X.signed("d1").alias("d"),
                  X.signed("d2").alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == ("1,344,005", "61.6%", "1.232", "+27.7", "-2.3")
    labels = spark.createDataFrame([("ACTION_GROUP_ohe_Dunk",), ("IS_CLUTCH",), ("LOC_X",),
                                    ("BASIC_ZONE_ohe_Mid-Range",)], "f string")
    out = labels.select(X.replace_all("f").alias("l"), X.feature_category("f").alias("c")).collect()
    assert [(r.l, r.c) for r in out] == [
        ("Action: Dunk", "Action"), ("Clutch Situation (Q4/OT, ≤120 s)", "Context"),
        ("Court X Coordinate", "Location"), ("Zone: Mid-Range", "Location")]


def test_derive_is_one_projection(spark):
    import contextlib
    import io
    df = D.derive_shots(frame(spark, [shot()]))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(extended=True)
    text = buf.getvalue()
    optimized = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimized.count("Project") == 1
    assert "PythonUDF" not in text and "BatchEvalPython" not in text
    assert F  # keep import used
