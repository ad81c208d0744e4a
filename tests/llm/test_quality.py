import random
import re
from collections import Counter

import numpy as np
from common import MIDDLE, edge_frame, empty_frame, table, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from shotframe.llm import boosting, quality
from shotframe.llm.queries import op12_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    found = WORD.findall(text)
    windows = Counter(tuple(found[i: i + 3]) for i in range(len(found) - 2))
    marked = {i + k for i in range(len(found) - 2) if windows[tuple(found[i: i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), again, len(marked))


def counts(texts):
    raw = [(t or "").encode() for t in texts]
    c = quality.statistics(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
    return list(zip(*(c[k].tolist() for k in quality.COUNTS))), c


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAé  日𝄞#| \n\t\r\x0b!1"), max_size=40), max_size=5))
def test_counts_equal_plain_counts(texts):
    assert counts(texts)[0] == [by_hand(t) for t in texts]


def test_more_counts():
    _, c = counts(["Aa! b2x b2x b2x\nthe the", "", "x" * 30])
    assert c["n_twins"].tolist() == [3, 0, 0] and c["n_top_word"].tolist() == [3, 0, 1]
    assert c["n_distinct_words"].tolist() == [3, 0, 1] and c["n_long_words"].tolist() == [0, 0, 1]
    assert c["n_plain_words"].tolist() == [3, 0, 1] and c["n_lines"].tolist() == [2, 0, 1]  # the last byte may be a mark
    assert c["n_exclaims"].tolist() == [1, 0, 0] and c["n_upper"].tolist() == [1, 0, 0]
    x = quality.features(c)
    assert x.shape == (3, len(quality.FEATURES)) and np.isfinite(x).all() and not x[1].any()


def test_trees_learn_and_keep_their_directions():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.1 * rng.normal(size=3000)) < 0.5).astype(int)
    free = boosting.train(x, y, np.array([0, 0, 0]))
    held = boosting.train(x, y, np.array([-1, 0, 1]))
    new = rng.random((1000, 3))
    wanted = (new[:, 0] + 0.3 * np.sin(9 * new[:, 1])) < 0.5
    for f in (free, held):
        assert ((f.probability(new) > 0.5) == wanted).mean() > 0.93
    for f, sign in ((0, -1), (2, 1)):
        line = np.repeat(new[:200], 50, axis=0)
        line[:, f] = np.tile(np.linspace(-0.1, 1.1, 50), 200)
        steps = sign * np.diff(held.margin(line).reshape(200, 50), axis=1)
        assert steps.min() >= -1e-9
    # without the constraint noise alone makes the score turn
    line = np.repeat(new[:200], 50, axis=0)
    line[:, 2] = np.tile(np.linspace(-0.1, 1.1, 50), 200)
    assert np.diff(free.margin(line).reshape(200, 50), axis=1).min() < 0


def test_flat_nodes_equal_a_walk():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 4, (500, 4)).astype(float), rng.integers(0, 2, 500)
    f = boosting.train(x, y, np.zeros(4, int), trees=7)

    def walk(row):
        total = f.base
        for n in f.roots:
            while f.left[n] != n:
                n = f.left[n] if row[f.feature[n]] <= f.threshold[n] else f.right[n]
            total += f.value[n]
        return total

    assert np.allclose(f.margin(x[:50]), [walk(r) for r in x[:50]])
    same = boosting.train(np.zeros((10, 2)), np.array([0, 1] * 5), np.array([0, 1]))
    assert np.allclose(same.probability(np.zeros((3, 2))), 0.5)


def test_query_counts_verdicts_and_held_out_accuracy(spark):
    out = {r.doc_id: r for r in op12_quality(spark, MIDDLE).collect()}
    docs = table("documents", MIDDLE)
    assert len(out) == len(docs)
    for d in docs:
        r = out[d["doc_id"]]
        own = by_hand(d["text"])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == own
        assert r.base_failed == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert not (r.base_failed and r.kept) and 0 <= r.score <= 1


def test_verdicts_on_documents_left_out_of_the_fit(spark):
    from shotframe.llm.shared import load

    big = MIDDLE.replace("0.01", "0.1")
    labels = load(spark, big, "labels")
    left_out = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    out = quality.judged(load(spark, big, "documents"), labels.where(~left_out))
    rows = out.join(labels.where(left_out), "doc_id").where("NOT base_failed").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert len(bad) > 20
    assert np.mean([r.kept for r in good]) > 0.98
    assert np.mean([r.kept for r in bad]) < 0.25


def test_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (9, 1, 0), (7, 0, 1), (7, 0, 1), (4, 0, 0), (None, 1, 1), (10, None, None), (3, 7, 0)],
                                   "doc_id bigint, quality int, toxic int")
    df = edge_frame(spark).withColumns({c: F.lit(0) for c in ("id", "label", "n_words", "base_failed")})
    for marks in (labels, labels.where("false")):
        rows = quality.judged(df, marks).collect()
        want = sorted(((r.doc_id, *by_hand(r.text)) for r in df.collect()), key=str)
        assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=str) == want
        assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
        assert {r.kept for r in rows if r.doc_id == 9} == {True}
        assert quality.judged(empty_frame(spark), marks).collect() == []


def test_symbols_never_help(spark):
    rng = random.Random(4)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)], "doc_id bigint, quality int")
    texts = [(i, words(rng.randrange(400), rng.randrange(450, 800)) if i % 3 else " ".join(rng.choice(("#", "x$")) for _ in range(99)))
             for i in range(600)]
    judge = quality.fit(quality.counted(spark.createDataFrame(texts, "doc_id bigint, text string")), labels)
    _, c = counts([words(0, 100)] * 20)
    c["n_symbols"] = np.arange(20) * 10
    assert (np.diff(judge.forest.margin(quality.features(c))) <= 1e-9).all()
