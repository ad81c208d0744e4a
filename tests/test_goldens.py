"""Post-processing operators on the published result tables.

The values below are the reference's published results (fixed values),
retyped as small fixtures; the operators must reproduce the figures the
reference reports from them.
"""

from pyspark.sql import functions as F

from helpers import as_dicts
from shotframe.operators import archetypes as C
from shotframe.operators import path as PT
from shotframe.operators import trend as W

# Published season table: SEASON_1, three_pt_rate_pct (fixed values).
SEASON_RATES = [
    (2004, 18.6), (2005, 19.5), (2006, 20.1), (2007, 21.1), (2008, 22.0), (2009, 22.2),
    (2010, 22.0), (2011, 22.0), (2012, 22.4), (2013, 24.2), (2014, 25.8), (2015, 26.7),
    (2016, 28.3), (2017, 31.4), (2018, 33.5), (2019, 35.7), (2020, 38.3), (2021, 39.1),
    (2022, 39.8), (2023, 38.6), (2024, 39.4),
]

# Published cluster profile (cluster, n, six shares) and the names the
# reference gives each cluster id (fixed values).
PROFILE = [
    (0, 1422, 0.313, 0.191, 0.156, 0.038, 0.035, 0.266),
    (1, 1136, 0.593, 0.226, 0.146, 0.005, 0.005, 0.024),
    (2, 866, 0.242, 0.086, 0.124, 0.116, 0.11, 0.323),
    (3, 1581, 0.213, 0.093, 0.251, 0.054, 0.049, 0.34),
    (4, 1446, 0.311, 0.148, 0.427, 0.015, 0.014, 0.086),
]
PUBLISHED_NAMES = {0: "Modern Versatile Scorer", 1: "Rim-Dominant Big",
                   2: "Floor-Spacing Specialist", 3: "High-Volume Perimeter",
                   4: "Mid-Range Specialist"}

# Published headline coefficients at regParam 0.001 (fixed values).
HEADLINE = [
    ("ACTION_GROUP_ohe_Dunk", 1.935775586563157),
    ("ZONE_RANGE_ohe_Back Court Shot", -1.341971139054009),
    ("ACTION_GROUP_ohe_Jump Shot", -0.3708159636808318),
    ("BASIC_ZONE_ohe_Restricted Area", 0.2952734766789802),
    ("ZONE_RANGE_ohe_Less Than 8 ft.", -0.17394573183742945),
    ("ZONE_RANGE_ohe_16-24 ft.", 0.08052768075567915),
    ("BASIC_ZONE_ohe_Left Corner 3", 0.07926474609847063),
    ("BASIC_ZONE_ohe_Right Corner 3", 0.0791044203830676),
    ("IS_CLUTCH", -0.0549377006705571),
    ("ACTION_GROUP_ohe_Other", -0.051843229974019966),
    ("BASIC_ZONE_ohe_In The Paint (Non-RA)", -0.03697797687896012),
    ("QUARTER", -0.017080394820989046),
    ("SHOT_DISTANCE", -0.015046978579282014),
    ("ACTION_GROUP_ohe_Hook", 0.012969374952201185),
    ("LOC_Y", -4.289044689872589e-4),
    ("SECS_REMAINING", 1.0130599401301046e-4),
    ("LOC_X", 0.0), ("IS_3PT", 0.0), ("SHOT_VALUE", 0.0), ("BASIC_ZONE_ohe_Mid-Range", 0.0),
    ("BASIC_ZONE_ohe_Above the Break 3", 0.0), ("SHOT_TYPE_ohe_2PT Field Goal", 0.0),
    ("SHOT_TYPE_ohe_3PT Field Goal", 0.0), ("ZONE_RANGE_ohe_24+ ft.", 0.0),
    ("ZONE_RANGE_ohe_8-16 ft.", 0.0), ("ACTION_GROUP_ohe_Layup", 0.0),
]


def _rates(spark):
    return spark.createDataFrame(SEASON_RATES, "SEASON_1 int, three_pt_rate_pct double")


def test_steepest_change_is_2017(spark):
    y = W.change_from_previous(_rates(spark), "SEASON_1", "three_pt_rate_pct")
    top = W.steepest_change(y, "SEASON_1").first()
    assert (top.prev_SEASON_1, top.SEASON_1, top.yoy_change) == (2016, 2017, 3.1)
    assert y.filter(F.col("SEASON_1") == 2004).first().yoy_change is None


def test_endpoint_change_doubles(spark):
    e = W.endpoint_change(_rates(spark), "SEASON_1", "three_pt_rate_pct").first()
    assert (e.first_value, e.last_value, e.change) == (18.6, 39.4, 20.8)
    assert e.ratio == 2.118


def test_yoy_per_entity_with_gap(spark):
    df = spark.createDataFrame([(1, 2001, 10.0), (1, 2003, 14.0), (1, 2004, 15.0),
                                (2, 2001, 5.0), (2, 2002, 9.0), (2, 2003, 13.0)],
                               "e int, s int, v double")
    y = W.change_from_previous(df, "s", "v", partition=["e"])
    top = {r.e: (r.s, r.yoy_change) for r in W.steepest_change(y, "s", partition=["e"]).collect()}
    assert top == {1: (2003, 4.0), 2: (2002, 4.0)}   # gap compares with last present; tie -> earliest


def test_archetype_names_match_published(spark):
    cols = "cluster int, n long, rim_share double, paint_share double, mid_share double, " \
           "lc3_share double, rc3_share double, atb3_share double"
    names = C.name_clusters(spark.createDataFrame(PROFILE, cols))
    assert {r.cluster: r.archetype for r in names.collect()} == PUBLISHED_NAMES


def test_coefficient_table_matches_figure_rules(spark):
    coefs = spark.createDataFrame(HEADLINE, "feature string, coefficient double")
    t = as_dicts(PT.coefficient_table(coefs))
    assert len(t) == 25                                   # back court excluded
    kept = [d["feature"] for d in t if d["kept"]]
    assert len(kept) == 10
    assert "QUARTER" not in kept and "IS_CLUTCH" in kept
    vals = [d["coefficient"] for d in t]
    assert vals == sorted(vals)
    cats = {d["feature"]: d["category"] for d in t}
    assert cats["ACTION_GROUP_ohe_Dunk"] == "Action" and cats["SECS_REMAINING"] == "Context"
    assert cats["LOC_Y"] == "Location"


def test_path_summaries_small_path(spark):
    rows = [(0.05, "a", 0.0), (0.05, "b", 0.3), (0.05, "c", 0.0),
            (0.01, "a", 0.0), (0.01, "b", 0.5), (0.01, "c", -0.1),
            (0.001, "a", 0.2), (0.001, "b", 0.6), (0.001, "c", -0.2),
            (10.0, "a", 0.0), (10.0, "b", 0.0), (10.0, "c", 0.0)]
    path = spark.createDataFrame(rows, "regParam double, feature string, coefficient double")
    counts = [(r.regParam, r.n_active) for r in PT.active_counts(path).collect()]
    assert counts == [(10.0, 0), (0.05, 1), (0.01, 2), (0.001, 3)]   # zero-active penalty kept
    entry = {r.feature: (r.entry_param, r.entry_rank) for r in PT.entry_order(path).collect()}
    assert entry == {"b": (0.05, 1), "c": (0.01, 2), "a": (0.001, 3)}
    top = [r.feature for r in PT.top_features(path, 2).collect()]
    assert top == ["b", "a"]
    wide = PT.path_wide(path, ["a", "b", "c"]).filter("regParam = 0.01").first()
    assert (wide.a, wide.b, wide.c) == (0.0, 0.5, -0.1)
    mono = PT.monotone_steps(PT.active_counts(path)).collect()
    assert all(r.non_decreasing for r in mono)


def test_shot_view_matches_expected_tables(spark):
    """FIXTURES.md section 3: expected zone and season tables of the shot view at sf0.01."""
    from conftest import SF_ORACLE
    from shotframe.plans.queries import queries
    q = queries()
    z = {r.BASIC_ZONE: (r.attempts, r.fg_pct, r.pts_per_attempt)
         for r in q["zone_efficiency"](spark, SF_ORACLE).collect()}
    assert z == {"Restricted Area": (4828, 70.8, 1.416), "Left Corner 3": (1806, 41.8, 1.254),
                 "Above the Break 3": (14293, 40.2, 1.206), "Right Corner 3": (1886, 40.0, 1.199),
                 "In The Paint (Non-RA)": (11716, 59.4, 1.187), "Mid-Range": (25280, 52.6, 1.051)}
    s = {r.SEASON_1: (r.total_attempts, r.three_pt_attempts, r.three_pt_rate_pct)
         for r in q["rate_by_season"](spark, SF_ORACLE).collect()}
    assert s == {1995: (8815, 1949, 22.1), 1996: (8901, 2236, 25.1), 1997: (8687, 2469, 28.4),
                 1998: (8876, 2703, 30.5), 1999: (8559, 2827, 33.0), 2000: (8733, 3112, 35.6),
                 2001: (7238, 2689, 37.2)}
    assert q["share_fingerprint"](spark, SF_ORACLE).count() == 700


def test_archetype_names_for_other_k(spark):
    cols = "cluster int, n long, rim_share double, paint_share double, mid_share double, " \
           "lc3_share double, rc3_share double, atb3_share double"
    extra = [(5, 10, 0.30, 0.20, 0.20, 0.05, 0.05, 0.20), (6, 10, 0.25, 0.20, 0.25, 0.05, 0.05, 0.20)]
    names = {r.cluster: r.archetype
             for r in C.name_clusters(spark.createDataFrame(PROFILE + extra, cols)).collect()}
    assert len(set(names.values())) == 7
    assert names[1] == "Rim-Dominant Big" and names[4] == "Mid-Range Specialist"
    assert sorted(n for n in names.values() if n.startswith(C.VERSATILE_NAME)) == [
        C.VERSATILE_NAME + " 1", C.VERSATILE_NAME + " 2", C.VERSATILE_NAME + " 3"]
    three = {r.cluster: r.archetype
             for r in C.name_clusters(spark.createDataFrame(PROFILE[:3], cols)).collect()}
    assert len(set(three.values())) == 3
