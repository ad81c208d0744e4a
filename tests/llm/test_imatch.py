import hashlib
import re
from collections import Counter, defaultdict

import xxhash
from common import SMALL, edge_docs, edge_frame, empty_frame, table
from pyspark.sql import functions as F
from shotframe.llm import imatch, neighbours
from shotframe.llm.queries import op10_imatch


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_lexicon_is_the_band(spark):
    docs = table("documents")
    df = Counter()
    for r in docs:
        df.update({w for w in re.split(r"[ \t\n\x0b\x0c\r]+", "".join(c.lower() if c.isascii() else c for c in r["text"] or "")) if w})
    n = len(docs)
    want = {signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w, k in df.items()
            if imatch.LOW * n <= k <= imatch.HIGH * n and k > 1}
    terms = spark.read.parquet(f"{SMALL}/documents.parquet").select(imatch.terms_of(F.col("text")).alias("terms"))
    assert set(imatch.lexicon(terms, thin=1, subsets=1)) == want
    some = set(imatch.lexicon(terms))
    assert some < want and abs(len(some) / len(want) - imatch.SUBSETS / imatch.THIN) < 0.1


def test_edited_texts_and_neighbours(spark):
    docs = sorted(((r["doc_id"], r["text"] or "") for r in table("documents")))
    out = {r.doc_id: r for r in op10_imatch(spark, SMALL).collect()}
    assert len(out) == len(docs)
    by_text = {}
    for k, (d, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[1][:half]
        r = out[d]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        parts = lambda x: [x[8 * i: 8 * i + 8] for i in range(imatch.SUBSETS)]
        same = lambda a, b: sum(x == y for x, y in zip(parts(a), parts(b))) / imatch.SUBSETS
        assert abs(r.near_edited - same(r.fingerprint, r.edited_fingerprint)) < 1e-12
        assert abs(r.near_next - same(r.fingerprint, out[following[0]].fingerprint)) < 1e-12
    assert len(set(by_text.values())) == len(by_text)


def test_order_and_repetition_of_words_do_not_count(spark):
    df = spark.createDataFrame([(1, "b a c"), (2, "A b\nc c b"), (3, "a b d"), (4, ""), (5, None)], "doc_id bigint, text string")
    f = {r.doc_id: r.fingerprint for r in imatch.fingerprints(df).collect()}
    assert f[1] == f[2] != f[3] and f[4] == f[5]


def test_edge_rows(spark):
    out = imatch.fingerprints(edge_frame(spark)).collect()
    assert len(out) == len(edge_docs())
    assert len({r.fingerprint for r in out if r.doc_id in (1, 2)}) == 1
    assert imatch.fingerprints(empty_frame(spark)).collect() == []


def test_next_row_across_ranges(spark, monkeypatch):
    rows = [(k * k, f"t{k}") for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for size in (16 << 20, 2):
        monkeypatch.setattr(neighbours, "RANGE_BYTES", size)
        got = {r.doc_id: r.nx.text for r in neighbours.with_next(df, "doc_id", "text", "nx").collect()}
        assert got == {k * k: f"t{(k + 1) % 500}" for k in range(500)}
    assert neighbours.with_next(df.limit(1), "doc_id", "text", "nx").first().nx.text == "t0"
    assert neighbours.with_next(df.where("false"), "doc_id", "text", "nx").collect() == []


def test_every_subset_is_its_share_of_the_band(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    terms = docs.select(imatch.terms_of(F.col("text")).alias("terms"))
    band = imatch.lexicon(terms, thin=1, subsets=1)
    lots = defaultdict(list)
    for r in spark.createDataFrame([(t,) for t in band], "t bigint").select("t", imatch.lot_of(F.col("t"), imatch.SUBSETS).alias("k")).collect():
        lots[r.k].append(r.t)
    assert set(lots) == set(range(imatch.SUBSETS)) and sum(map(len, lots.values())) == len(band)
    # leaving out one lot's terms changes that subset's hash and no other, in every document that has such terms
    parts = lambda x: [x[8 * i: 8 * i + 8] for i in range(imatch.SUBSETS)]
    whole = {r.doc_id: parts(r.fingerprint) for r in imatch.fingerprints(docs).collect()}
    has = {r.doc_id: set(r.terms) for r in docs.withColumn("terms", imatch.terms_of(F.col("text"))).collect()}
    for k in (0, 7, 23):
        rest = [t for t in band if t not in set(lots[k])]
        for r in imatch.with_fingerprint(docs, "text", rest, thin=imatch.SUBSETS).collect():
            known = has[r.doc_id] & set(band)
            if known - set(lots[k]):
                changed = {i for i, (a, b) in enumerate(zip(whole[r.doc_id], parts(r.fingerprint))) if a != b}
                assert changed == ({k} if known & set(lots[k]) else set())


def test_native_plan(spark):
    plan = op10_imatch(spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)


def test_columns_of_any_name_stay(spark):
    from common import edge_frame
    from shotframe.llm import neighbours
    names = ("row", "terms", "_terms", "known", "_known", "every", "parts", "_parts", "id", "coarse", "_coarse", "fine", "next", "_next",
             "head", "first", "at", "a.b")
    df = edge_frame(spark).drop("fingerprint").withColumns({c: F.lit(k) for k, c in enumerate(names)})
    out = neighbours.with_next(df, "doc_id", "text", "following", lambda x: imatch.with_fingerprint(x, "text", [1, 2, 3]))
    assert out.columns == df.columns + ["fingerprint", "following"]
    rows = out.collect()
    assert len(rows) == 14 and all([r[c] for c in names] == list(range(len(names))) for r in rows)
    assert all(r.following.fingerprint and r.following["a.b"] == len(names) - 1 for r in rows)


def test_derived_columns_of_the_next_row(spark):
    from shotframe.llm import neighbours
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("doc_id"), F.concat(F.lit("t"), F.col("id") * 7 % 500).alias("text"))
    out = neighbours.with_next(df, "doc_id", "text", "n", lambda x: x.withColumn("twice", F.concat("text", "text")))
    for r in out.collect():
        k = (r.doc_id + 1) % 500
        assert (r.twice, r.n.doc_id, r.n.twice) == (f"t{r.doc_id}" * 2, k, f"t{k}t{k}")
