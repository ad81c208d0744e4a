import zlib

import numpy as np
from common import MIDDLE, edge_frame, empty_frame
from pyspark.sql import functions as F
from shotframe.llm import langid
from shotframe.llm.queries import op7_langid


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in langid._start(3, rng).items()}
    data = rng.integers(97, 110, (6, 4))
    wanted, weight = np.array([0, 1, 2, 1]), np.ones((6, 4))

    def loss():
        p = langid._probabilities(w, langid._direction(w, "f", data, False)[0], langid._direction(w, "b", data, False)[0])
        return -np.log(p[:, wanted, np.arange(4)]).mean()

    grads = langid._gradients(w, data, wanted, weight)
    for key, at in (("uf", (3, 2)), ("ub", (20, 1)), ("xf", (int(data[2, 1]), 19)), ("vb", (1, 4)), ("bf", (2, 0)), ("c", (1,))):
        old, step = w[key][at], 1e-2
        w[key][at] = old + step
        up = loss()
        w[key][at] = old - step
        down = loss()
        w[key][at] = old
        assert abs((up - down) / (2 * step) - grads[key][at]) < 2e-3, key


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op7_langid(spark, MIDDLE).collect()}
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang").collect()
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 5 == 0]
    assert all(got[d.doc_id].held_out for d in held)
    assert len(got) == len(docs) and sum(r.held_out for r in got.values()) == len(held)
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edge_rows(spark):
    df = edge_frame(spark)
    net = langid.train([b"the cat and the dog " * 9, b"der hund und die katze " * 9] * 20, ["en", "de"] * 20)
    out = langid.identify(df, net).collect()
    assert len(out) == 14
    assert {r.lang_pred for r in out if r.doc_id in (4, 5, 6, 11)} == {"und"}
    assert "und" not in {r.lang_pred for r in out if r.doc_id in (1, 7, 9)}
    assert {r.lang_pred for r in langid.identify(df, None).collect()} == {"und"}
    assert langid.fit(empty_frame(spark), F.lit(True)) is None
    assert langid.identify(empty_frame(spark), net).collect() == []


def test_a_language_seen_only_late_in_long_texts_is_learned(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").where("lang IN ('en', 'de')").limit(120)
    blank = "1 " * 15000
    rows = [(r.doc_id, blank + " ".join([r.text or ""] * 10), r.lang) for r in docs.collect()]
    net = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True))
    out = langid.identify(docs.where("length(text) > 200"), net).collect()
    assert np.mean([r.lang_pred == r.lang for r in out]) > 0.95


def test_texts_of_no_learned_language_are_rejected_and_others_stay(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rest = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    net = langid.fit(docs, rest == 0)
    rng = np.random.default_rng(3)
    noise = ["".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 300)) for _ in range(5)]
    noise += [" ".join("".join(rng.choice(list("qwxzjkvbp"), 7)) for _ in range(60))]
    other = ["今天天气很好我们去公园散步吧" * 20, "Сегодня хорошая погода и мы идём гулять " * 10, "Η θάλασσα είναι ήρεμη σήμερα " * 10]
    strange = spark.createDataFrame([(i, t) for i, t in enumerate(noise + other)], "doc_id bigint, text string")
    assert {r.lang_pred for r in langid.identify(strange, net, reject=True).collect()} == {"und"}
    assert "und" not in {r.lang_pred for r in langid.identify(strange, net).collect()}
    left = docs.where((rest == 1) & F.col("text").rlike("[A-Za-z]"))
    kept = [r.lang_pred != "und" for r in langid.identify(left, net, reject=True).collect()]
    assert np.mean(kept) >= 0.99


def test_known_shares():
    net = langid.Network(["en"], {})
    texts = [b"abcd", b"", b"ab", b"ABCX", b"1234", b"xyz abcd"]
    buf, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    assert langid.known_shares(net, buf, offsets).tolist() == [1.0] * 6
    langid.learn_spelling(net, [[b"abcd"]] * 50)
    assert langid.known_shares(net, buf, offsets).tolist() == [1.0, 1.0, 1.0, 0.5, 1.0, 2 / 5] and net.least_known > 0.7
