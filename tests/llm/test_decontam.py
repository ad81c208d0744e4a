import random
import re

import numpy as np
import pyarrow as pa
from common import MIDDLE, edge_frame, empty_frame, table, words
from shotframe.llm import decontam
from shotframe.llm.queries import op3_decontam
from shotframe.llm.shared import slices


def norm(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def test_finds_every_verbatim_item_and_nothing_else(spark):
    items = {r["item_id"]: " ".join(norm(r["text"])) for r in table("benchmark", MIDDLE)}
    want = {r["doc_id"]: sorted(k for k, v in items.items() if f" {v} " in f" {' '.join(norm(r['text']))} ")
            for r in table("documents", MIDDLE)}
    got = {r.doc_id: list(r.item_ids) for r in op3_decontam(spark, MIDDLE).collect()}
    assert got == want and any(want.values())


def test_edit_distance_equals_dynamic_programming():
    rng = random.Random(4)
    for _ in range(60):
        p = [rng.randrange(5) for _ in range(rng.randint(1, 12))]
        t = [rng.randrange(5) for _ in range(rng.randint(0, 20))]
        row = list(range(len(p) + 1))
        best = row[-1]
        for x in t:
            new = [0]
            for i, y in enumerate(p, 1):
                new.append(min(row[i - 1] + (x != y), row[i] + 1, new[-1] + 1))
            row = new
            best = min(best, row[-1])
        masks = {}
        for i, y in enumerate(p):
            masks[y] = masks.get(y, 0) | 1 << i
        assert decontam.edit_distance_in(masks, len(p), t)[0] == best


def test_recall_of_edited_items():
    rng = random.Random(3)
    items = [(r["item_id"], r["text"]) for r in table("benchmark", "/root/testdata/sf0.1")]
    docs = [norm(r["text"]) for r in table("documents", MIDDLE)][:200]
    vocabulary = sorted({w for d in docs for w in d})
    index = decontam.Index(items)
    texts, want = [], []
    for k, (item, text) in enumerate(items):
        w = norm(text)
        for at in rng.sample(range(len(w)), len(w) // 10):
            w[at] = rng.choice(["", rng.choice(vocabulary), w[at] + " " + rng.choice(vocabulary)])
        base = docs[k % len(docs)]
        texts.append(" ".join(base[:80] + [x for x in w if x] + base[80:]))
        want.append(item)
    got = set()
    for at, buf, offsets in slices(pa.array(texts)):
        got |= {(at + owner, index.ids[i]) for owner, i, *_ in decontam.search(index, buf, offsets)}
    assert np.mean([(k, item) in got for k, item in enumerate(want)]) >= 0.99


def test_recall_at_the_largest_edit_share():
    for m in (8, 10, 20, 40, 128, 250, 500):
        rng = random.Random(m)
        vocabulary = [f"v{i}" for i in range(3000)]
        draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
        items = [(k, " ".join(draw(m))) for k in range(200)]
        index = decontam.Index(items)
        texts = []
        for _, text in items:
            w = text.split()
            for at in rng.sample(range(m), int(decontam.MAX_EDIT_SHARE * m)):
                w[at] = rng.choice(["", rng.choice(vocabulary), w[at] + " " + rng.choice(vocabulary)])
            texts.append(" ".join(draw(60) + [x for x in w if x] + draw(60)))
        got = set()
        for at, buf, offsets in slices(pa.array(texts)):
            got |= {(at + owner, index.ids[i]) for owner, i, *_ in decontam.search(index, buf, offsets)}
        assert np.mean([(k, k) in got for k, _ in items]) >= 0.99, m


def found_in(index, texts):
    """What a slice of all texts together gives: {(text, item): distance}."""
    out = {}
    for at, buf, offsets in slices(pa.array(texts, pa.string()), 1 << 30):
        out |= {(at + owner, index.ids[i]): d for owner, i, d, _ in decontam.search(index, buf, offsets)}
    return out


def test_documents_that_begin_or_end_inside_an_item():
    """The same found alone and between any neighbours, wherever up to a fifth of the item's words is missing."""
    for m, missing in ((8, 1), (10, 2), (20, 2), (20, 4), (40, 6), (40, 8), (100, 10), (100, 20), (300, 60)):
        rng = random.Random(m * missing)
        vocabulary = [f"v{i}" for i in range(3000)]
        draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
        items = [(k, " ".join(draw(m))) for k in range(100)]
        index = decontam.Index(items)
        for cut_start in (True, False):
            texts = []
            for _, text in items:
                w = text.split()
                texts.append(" ".join(w[missing:] + draw(rng.randint(0, 30)) if cut_start else draw(rng.randint(0, 30)) + w[:-missing]))
            alone = {(k, i): d for k, t in enumerate(texts) for (_, i), d in found_in(index, [t]).items()}
            assert np.mean([(k, k) in alone for k, _ in items]) >= 0.99, (m, missing, cut_start)
            assert found_in(index, texts) == alone
            order = rng.sample(range(100), 100)
            between = found_in(index, [x for k in order for x in (" ".join(draw(rng.randint(0, 50))), texts[k])])
            assert {(order[t // 2], i): d for (t, i), d in between.items() if t % 2} == alone


def test_query_over_all_windows_by_brute_force(spark):
    """Edited items among neighbouring documents, against the edit distance of every document, at any partition count."""
    rng = random.Random(12)
    vocabulary = [f"v{i}" for i in range(400)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {k: draw(rng.choice((8, 12, 20, 35))) for k in range(12)}
    docs = {}
    for d in range(300):
        w = list(items[rng.randrange(12)])
        for _ in range(rng.randint(0, len(w) // 5)):
            at = rng.randrange(len(w))
            w[at: at + 1] = rng.choice(([], [rng.choice(vocabulary)], [w[at], rng.choice(vocabulary)]))
        docs[d] = rng.choice(([], draw(rng.randint(0, 40)))) + w[rng.randint(0, 1):] + rng.choice(([], draw(rng.randint(0, 40))))
    want = {}
    for d, w in docs.items():
        for k, item in items.items():
            row = [0] * (len(w) + 1)
            for i, x in enumerate(item, 1):
                new = [i]
                for j, y in enumerate(w, 1):
                    new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
                row = new
            if min(row) <= int(decontam.MAX_EDIT_SHARE * len(item)):
                want[d, k] = min(row)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id bigint, text string")
    results = []
    for parts in (1, 2, 7):
        df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id bigint, text string").coalesce(1)
        df = df if parts == 1 else df.repartition(parts, "doc_id")
        results.append({(r.doc_id, i): x for r in decontam.matches(df, bench).collect() for i, x in zip(r.item_ids, r.distances)})
        assert {r.doc_id for r in decontam.clean(df, bench).collect()} == set(docs) - {d for d, _ in results[-1]}
    assert results[0] == results[1] == results[2]
    assert set(results[0]) <= set(want) and len(results[0]) >= 0.99 * len(want)
    assert all(results[0][x] == want[x] for x in results[0])


def test_edge_rows(spark):
    df = edge_frame(spark)
    bench = spark.createDataFrame([(1, words(10, 40)), (1, words(10, 40)), (2, None), (None, words(0, 20)), (3, "too few words"),
                                   (4, "")], "item_id bigint, text string")
    got = [(r.doc_id, r.contaminated) for r in decontam.contaminated(df, bench).collect()]
    assert len(got) == 14
    assert {d for d, c in got if c} == {1, 2, 3, 9, 10, None}
    clean = decontam.clean(df, bench)
    assert clean.columns == df.columns
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted([4, 5, 6, 7, 8, 11, None], key=repr)
    none = bench.where("false")
    assert not any(r.contaminated for r in decontam.contaminated(df, none).collect())
    assert decontam.clean(df, none).count() == 14
    assert decontam.contaminated(empty_frame(spark), bench).collect() == []


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    df = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    bench = spark.read.parquet(f"{MIDDLE}/benchmark.parquet")
    whole = decontam.clean(df, bench).count()
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 15)
    assert decontam.clean(df, bench).count() == whole


def test_blocks_of_items_give_one_row_a_document(spark, monkeypatch):
    bench = table("benchmark", MIDDLE)
    passage = bench[0]["text"] + " " + bench[1]["text"] + " " + bench[2]["text"]
    df = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, passage), (-2, None), (-2, passage), (None, passage)], "doc_id bigint, text string")).cache()
    items = spark.read.parquet(f"{MIDDLE}/benchmark.parquet")
    whole = sorted(map(tuple, decontam.contaminated(df, items).collect()), key=repr)
    assert len(whole) == df.count() and [r[2] for r in whole if r[0] == -1] == [3]
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 15)
    assert sorted(map(tuple, decontam.contaminated(df, items).collect()), key=repr) == whole


def test_short_items_are_found_verbatim(spark):
    short = ["what is the capital of france", "Name a prime!", "one two three four five six seven", "solo", "solo", "...", "", "a b"]
    bench = spark.createDataFrame(list(enumerate(short)) + [(20, words(0, 30))], "item_id bigint, text string")
    texts = ["so: What is the capital of France? right, and what is the capital of france", "what is the capital of spain",
             "name a prime", "one two three four five six", "zero one two three four five six seven eight", "solo; solo", "soloist",
             "a", "b", None, "", words(0, 30) + " a  b", "france what is the capital of"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    found = {r.doc_id: r for r in decontam.matches(df, bench).collect()}
    assert {d: r.item_ids for d, r in found.items() if r.item_ids} == {
        0: [0], 2: [1], 4: [2], 5: [3, 4], 11: [7, 20]}
    assert found[0].distances == [0] and found[0].ends == [texts[0].index("?")] and found[4].ends == [len(texts[4]) - 6]
    assert {r.doc_id for r in decontam.clean(df, bench).collect()} == set(range(13)) - {0, 2, 4, 5, 11}
    # against every window of the texts, with short items cut out of the texts themselves
    docs = {r["doc_id"]: norm(r["text"]) for r in table("documents")}
    rng = random.Random(8)
    items = {}
    for k in range(60):
        w = docs[rng.choice([d for d, x in docs.items() if len(x) > 20])]
        at = rng.randrange(len(w) - 8)
        items[k] = w[at: at + 1 + k % 7]
    got = decontam.matches(spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id bigint, text string"),
                           spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id bigint, text string"))
    assert {r.doc_id: r.item_ids for r in got.collect()} == {
        d: [k for k, i in items.items() if f" {' '.join(i)} " in f" {' '.join(w)} "] for d, w in docs.items()}
