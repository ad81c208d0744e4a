from collections import Counter

import numpy as np
from common import MIDDLE, edge_docs, edge_frame, empty_frame
from pyspark.sql import functions as F
from shotframe.llm import mixing
from shotframe.llm.queries import op9_mixing


def test_margins_meet_their_targets(spark):
    rows = op9_mixing(spark, MIDDLE).collect()
    total = sum(r.tokens for r in rows)
    weight = {}
    for r in rows:
        weight[r.source, r.lang, r.topic] = r.weight
    for at, margin in enumerate(mixing.MARGINS):
        own = Counter()
        for r in rows:
            own[r[margin]] += r.tokens
        raw = {k: n**mixing.SMOOTHING for k, n in own.items() if n}
        want = {k: v / sum(raw.values()) for k, v in raw.items()}
        got = Counter()
        for k, w in weight.items():
            got[k[at]] += w
        for k in want:
            assert abs(got[k] - want[k]) < 2e-3
    expected = sum(r.tokens * r.probability for r in rows)
    assert abs(expected - mixing.KEEP_SHARE * total) < 1e-3 * total
    assert abs(sum(r.tokens for r in rows if r.kept) - expected) < 0.1 * total
    assert all(0 <= r.probability <= 1 for r in rows)


def test_rake_equals_numpy(spark):
    seed = np.array([[10.0, 3, 0], [4, 8, 6]])
    a, b = np.array([0.5, 0.5]), np.array([0.4, 0.4, 0.2])
    m = seed.copy()
    for _ in range(2000):
        m *= (a / m.sum(1))[:, None]
        m *= (b / m.sum(0))[None, :]
    cells = spark.createDataFrame([(f"s{i}", f"l{j}", int(seed[i, j])) for i in range(2) for j in range(3) if seed[i, j]],
                                  "source string, lang string, tokens bigint")
    targets = {"source": spark.createDataFrame([(f"s{i}", float(x)) for i, x in enumerate(a)], "value string, target double"),
               "lang": spark.createDataFrame([(f"l{i}", float(x)) for i, x in enumerate(b)], "value string, target double")}
    for r in mixing.rake(cells, targets, tolerance=1e-7).collect():
        assert abs(r.weight - m[int(r.source[1]), int(r.lang[1])]) < 1e-5


def test_probabilities_cap_at_one(spark):
    cells = spark.createDataFrame([("a", 100, 0.6), ("b", 1000, 0.2), ("c", 900, 0.2)], "source string, tokens bigint, weight double")
    p = {r.source: r.probability for r in mixing.calibrated(cells, 0.5).collect()}
    assert p["a"] == 1.0
    assert abs(100 + 1000 * p["b"] + 900 * p["c"] - 1000) < 0.1
    assert abs(p["b"] * 1000 - p["c"] * 900) < 0.1


def test_edge_rows(spark):
    df = edge_frame(spark)
    out = mixing.mixed(df).collect()
    assert len(out) == len(edge_docs())
    assert all(r.mix.kept and r.mix.probability == 1.0 for r in out if r.doc_id in (4, 5, 6))
    assert {r.mix.source for r in out if r.doc_id == 3} == {"unknown"}
    assert mixing.mixed(empty_frame(spark)).collect() == []


def test_tokens(spark):
    df = spark.createDataFrame([("a b\tc",), (None,), ("",), (" \n",), ("one",)], "t string")
    assert [r[0] for r in df.select(mixing.tokens_of(F.col("t"))).collect()] == [3, 0, 0, 0, 1]


def test_given_targets_are_met_or_said_not_to_be(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "word " * int(rng.integers(5, 60)), str(rng.choice(["en", "de"])), str(rng.choice(["a", "b", "c"])), 0) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    aim = {"source": {"a": 6, "b": 3, "c": 1}, "lang": {"en": 0.8, "de": 0.2}}
    out = mixing.mixed(df, targets=aim, keep_share=0.3).select("doc_id", "mix.*").collect()
    cells = {(r.source, r.lang, r.topic): r.weight for r in out}
    for at, want in ((0, {"a": 0.6, "b": 0.3, "c": 0.1}), (1, {"en": 0.8, "de": 0.2})):
        got = Counter()
        for k, w in cells.items():
            got[k[at]] += w
        assert all(abs(got[v] - x) < 1e-3 for v, x in want.items())
    assert all(r.converged for r in out)
    left_out = mixing.mixed(df, targets={"source": {"a": 1}}).select("mix.*").collect()
    assert all(not r.kept and r.weight == 0 for r in left_out if r.source != "a") and any(r.kept for r in left_out)


def test_impossible_targets_are_flagged(spark):
    cells = spark.createDataFrame([("a", "x", 10), ("b", "y", 10)], "source string, lang string, tokens bigint")

    def t(shares):
        return spark.createDataFrame(list(shares.items()), "value string, target double")

    out = mixing.rake(cells, {"source": t({"a": 0.9, "b": 0.1}), "lang": t({"x": 0.5, "y": 0.5})}, max_rounds=20).collect()
    assert all(r.deviation > 0.3 for r in out)
    gone = mixing.rake(cells, {"source": t({"a": 0.5, "b": 0.3, "c": 0.2})}).collect()
    assert all(abs(r.deviation - 0.2) < 1e-9 for r in gone)
    fine = mixing.rake(cells, {"source": t({"a": 0.5, "b": 0.5}), "lang": t({"x": 0.5, "y": 0.5})}).collect()
    assert all(r.deviation <= 1e-4 for r in fine)


def test_columns_of_any_name_stay(spark):
    df = edge_frame(spark).withColumns({c: F.lit(k) for k, c in enumerate(
        ("row", "own", "draw", "_weight", "_source", "cell_source", "weight", "probability", "deviation", "topic", "tokens", "converged"))})
    out = mixing.mixed(df)
    assert out.columns == [c for c in df.columns if c != "mix"] + ["mix"]
    assert all((r["row"], r.own, r.draw, r.weight, r.converged) == (0, 1, 2, 6, 11) for r in out.collect())
