import random

import numpy as np
from common import edge_frame, empty_frame
from pyspark.sql import functions as F
from shotframe.llm import toxicity


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        bag = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice('aeiou')}" for _ in range(rng.randint(20, 200))]
        bad = int(k % 4 == 0)
        for _ in range(3 * bad):
            bag[rng.randrange(len(bag))] = rng.choice(["vilify", "scumbag", "moronic", "loathing"])
        out.append((" ".join(bag), bad))
    return out


def test_separates_unseen_texts():
    learn, new = corpus(800, 1), corpus(300, 2)
    model = toxicity.train([t for t, _ in learn], [y for _, y in learn], ["en"] * len(learn))
    rows = [toxicity.word_buckets(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for t, _ in new]
    p = np.array([toxicity.probabilities(model.weights, r, np.array([0, len(r)]))[0] for r in rows])
    y = np.array([y for _, y in new])
    auc = (p[y == 1][:, None] > p[y == 0][None, :]).mean()
    assert auc > 0.95
    assert 0 < model.thresholds["en"] < 1


def test_batches_and_single_texts_agree():
    model = toxicity.train([t for t, _ in corpus(100, 3)], [y for _, y in corpus(100, 3)], ["en"] * 100)
    raw = [t.encode() for t in ("one two", "", "three", "four five six seven")]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    both = toxicity.probabilities(model.weights, *toxicity.word_buckets(buf, np.cumsum([0] + [len(r) for r in raw])))
    for r, p in zip(raw, both):
        own = toxicity.word_buckets(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert abs(toxicity.probabilities(model.weights, *own)[0] - p) < 1e-6


def test_edge_rows(spark):
    df = edge_frame(spark)
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (7, 0, 1), (None, 1, 1), (9, None, None), (2, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(df, labels, F.lit(True))
    out = toxicity.score(df, model).collect()
    assert len(out) == 14 and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (4, 5, 6, 11)}) == 1
    assert toxicity.fit(empty_frame(spark), labels, F.lit(True)) is None
    assert {r.score for r in toxicity.score(df, None).collect()} == {0.0}
    assert toxicity.score(empty_frame(spark), model).collect() == []


def test_threshold_of_best_f1():
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.3, 0.1]), np.array([1, 1, 0, 0])) == 0.8


def test_decision_takes_the_threshold_of_the_language(spark):
    learn = corpus(100, 5)
    model = toxicity.train([t for t, _ in learn], [y for _, y in learn], ["en"] * 100)
    text = learn[0][0]
    p = toxicity.score(spark.createDataFrame([(0, text)], "doc_id bigint, text string"), model).first().score
    model.thresholds, model.default_threshold = {"en": p - 0.01, "de": p + 0.01, "fr": p - 0.01}, p + 0.01
    df = spark.createDataFrame([(k, text, lang) for k, lang in enumerate(("en", "de", "fr", "xx", None))],
                               "doc_id bigint, text string, lang string")
    out = toxicity.score(df, model, lang_col="lang")
    assert out.columns == ["doc_id", "score", "decision"]
    assert {r.doc_id: r.decision for r in out.collect()} == {0: 1, 1: 0, 2: 1, 3: 0, 4: 0}
    model.default_threshold = p - 0.01
    assert {r.doc_id: r.decision for r in toxicity.score(df, model, lang_col="lang").collect()} == {0: 1, 1: 0, 2: 1, 3: 1, 4: 1}
    assert {r.decision for r in toxicity.score(df, None, lang_col="lang").collect()} == {0}
    assert toxicity.score(df, model).columns == ["doc_id", "score"]


def test_long_labelled_texts_take_part(spark):
    learn, new = corpus(240, 6), corpus(120, 7)
    filler = " ".join(f"zz{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(4000))
    docs = spark.createDataFrame([(i, filler + " " + t, "en") for i, (t, _) in enumerate(learn)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(learn)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    got = toxicity.score(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(new)], "doc_id bigint, text string"), model).collect()
    p, y = np.array([r.score for r in sorted(got, key=lambda r: r.doc_id)]), np.array([y for _, y in new])
    assert (p[y == 1][:, None] > p[y == 0][None, :]).mean() > 0.9


def test_sample_ends_at_its_words(spark, monkeypatch):
    learn = corpus(60, 8)
    docs = spark.createDataFrame([(i, t, "en") for i, (t, _) in enumerate(learn)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(learn)], "doc_id bigint, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train_rows", lambda rows, *a: seen.append(rows))
    toxicity.fit(docs, labels, F.lit(True))
    monkeypatch.setattr(toxicity, "MOST_WORDS", 2000)
    toxicity.fit(docs, labels, F.lit(True))
    assert len(seen[0]) == 60 and 0 < len(seen[1]) < 60 and sum(map(len, seen[1])) <= 2000
    raw = np.frombuffer(learn[0][0].encode(), np.uint8)
    assert any((r == toxicity.word_buckets(raw, np.array([0, len(raw)]))[0]).all() for r in seen[0] if len(r) == len(learn[0][0].split()) + 3)
