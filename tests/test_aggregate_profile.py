"""A and Q families on hand-written rows: NULL keys, zero denominators, ties."""

from helpers import as_dicts, frame, shot
from shotframe.functions import derive as D
from shotframe.operators import aggregate as A
from shotframe.operators import profile as Q
from shotframe.schema import DEFAULT_COLUMNS


def _fp_rows():
    rows = []
    # player 1: 199 attempts (dropped at min 200), player 2: 200 (kept)
    rows += [shot(PLAYER_ID=1, BASIC_ZONE="Mid-Range") for _ in range(199)]
    rows += [shot(PLAYER_ID=2, BASIC_ZONE="Restricted Area") for _ in range(150)]
    rows += [shot(PLAYER_ID=2, BASIC_ZONE="Left Corner 3") for _ in range(50)]
    rows += [shot(PLAYER_ID=2, BASIC_ZONE="Backcourt")]           # zone outside the six
    rows += [shot(PLAYER_ID=None, PLAYER_NAME="N", BASIC_ZONE="Mid-Range") for _ in range(200)]
    return rows


def test_share_fingerprint_support_and_null_keys(spark):
    df = D.derive_shots(frame(spark, _fp_rows()))
    fp = {d["PLAYER_ID"]: d for d in as_dicts(A.share_fingerprint(df, DEFAULT_COLUMNS))}
    assert set(fp) == {2, None}                  # 199 dropped; NULL key kept as NULL, not 0
    p2 = fp[2]
    assert p2["total_attempts"] == 200           # the unlisted zone does not count
    assert p2["rim_share"] == 0.75 and p2["lc3_share"] == 0.25 and p2["mid_share"] == 0.0
    assert p2["ERA"] == "post"


def test_pivot_fill_keeps_null_keys(spark):
    df = D.derive_shots(frame(spark, _fp_rows()))
    zones = list(DEFAULT_COLUMNS.zones)
    names = [b + "_cnt" for b in DEFAULT_COLUMNS.zones.values()]
    a = A.pivot_counts(df, ["PLAYER_ID"], "BASIC_ZONE", zones, names, use_pivot=True)
    b = A.pivot_counts(df, ["PLAYER_ID"], "BASIC_ZONE", zones, names, use_pivot=False)
    da, db = as_dicts(a, ["PLAYER_ID"]), as_dicts(b, ["PLAYER_ID"])
    assert da == db
    assert any(d["PLAYER_ID"] is None for d in da)


def test_group_comparison_missing_level(spark):
    df = spark.createDataFrame([(0, "pre"), (0, "pre"), (1, "pre")], "cluster int, ERA string")
    out = {d["cluster"]: d for d in as_dicts(A.group_comparison(df, "cluster", "ERA"))}
    assert out[0]["pre"] == 2 and out[0]["post"] == 0
    assert out[0]["pre_pct"] == 66.7 and out[0]["post_pct"] is None   # empty era: NULL, no error


def test_group_comparison_rounds_before_difference(spark):
    # counts of the published era table: delta is the difference of rounded percentages
    rows = [(0, 260, 1162), (1, 602, 534), (2, 276, 590), (3, 873, 708), (4, 1196, 250)]
    long = [(c, "pre") for c, pre, _ in rows for _ in range(pre)] + \
           [(c, "post") for c, _, post in rows for _ in range(post)]
    df = spark.createDataFrame(long, "cluster int, ERA string")
    out = [(d["pre_pct"], d["post_pct"], d["delta_pct"])
           for d in as_dicts(A.group_comparison(df, "cluster", "ERA"), ["cluster"])]
    assert out == [(8.1, 35.8, 27.7), (18.8, 16.5, -2.3), (8.6, 18.2, 9.6),
                   (27.2, 21.8, -5.4), (37.3, 7.7, -29.6)]


def test_metrics_zero_denominators(spark):
    no_pos_pred = spark.createDataFrame([(0, 0), (1, 0)], "y int, p int")
    m = A.binary_metrics(A.confusion_counts(no_pos_pred, "y", "p")).first()
    assert m.precision == 0.0 and m.recall == 0.0 and m.accuracy == 0.5
    no_pos_label = spark.createDataFrame([(0, 0), (0, 1)], "y int, p int")
    m = A.binary_metrics(A.confusion_counts(no_pos_label, "y", "p")).first()
    assert m.recall == 0.0 and (m.tn, m.fp, m.fn, m.tp) == (1, 1, 0, 0)


def test_weighted_f1_matches_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rows = [(1.0, 1.0)] * 7 + [(1.0, 0.0)] * 3 + [(0.0, 1.0)] * 4 + [(0.0, 0.0)] * 9
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = A.binary_metrics(A.confusion_counts(df, "label", "prediction"), digits=None).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert abs(ours.f1_weighted - ev.setMetricName("f1").evaluate(df)) < 1e-12
    assert abs(ours.accuracy - ev.setMetricName("accuracy").evaluate(df)) < 1e-12


def test_null_profile_reports_missing(spark):
    df = frame(spark, [shot(LOC_X=None), shot()])
    out = {d["column_name"]: d for d in as_dicts(Q.null_profile(df, ["LOC_X", "SHOT_MADE_FLAG"]))}
    assert out["LOC_X"]["null_count"] == 1 and out["LOC_X"]["status"] == "present"
    assert out["SHOT_MADE_FLAG"]["status"] == "missing" and out["SHOT_MADE_FLAG"]["null_count"] is None


def test_distinct_counts_null_as_value(spark):
    df = frame(spark, [shot(BASIC_ZONE=None), shot(BASIC_ZONE="Mid-Range"), shot(BASIC_ZONE="Mid-Range")])
    out = Q.distinct_counts(df, ["BASIC_ZONE"]).first()
    assert out.n_distinct == df.select("BASIC_ZONE").distinct().count() == 2


def test_coverage_discovers_season(spark):
    df = frame(spark, [shot(SEASON_1=2004), shot(SEASON_1=2005), shot(SEASON_1=2005)])
    assert Q.find_column(df) == "SEASON_1"
    assert [(r[0], r[1]) for r in Q.coverage(df).collect()] == [(2004, 1), (2005, 2)]


def test_quantiles_exact_interpolate(spark):
    df = spark.createDataFrame([(x,) for x in [200, 210, 250, 400]], "t long")
    r = Q.quantile_summary(df, "t", exact=True).first()
    assert (r["min"], r.p25, r.p50, r.p75, r["max"]) == (200, 207.5, 230.0, 287.5, 400)


def test_auc_rank_with_ties_against_bruteforce(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 1), rnd.randint(0, 30)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "y int, s int")
    from shotframe.operators.evaluate import auc_rank
    got = auc_rank(df, "y", "s", digits=None, buckets=8).first().auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    num = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    assert abs(got - num / (len(pos) * len(neg))) < 1e-12


def test_prefix_sum_matches_cumsum(spark):
    from shotframe.operators.evaluate import prefix_sum_exclusive
    df = spark.createDataFrame([(i * 3 + 1, i % 7) for i in range(500)], "s long, v long")
    out = {r.s: r.prefix for r in prefix_sum_exclusive(df, "s", "v", buckets=16).collect()}
    acc = 0
    for i in range(500):
        assert out[i * 3 + 1] == acc
        acc += i % 7
