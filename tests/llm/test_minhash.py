import re
from collections import Counter, defaultdict

import pytest
from common import MIDDLE, SMALL, edge_docs, edge_frame, empty_frame, table, words
from shotframe.llm import minhash


def brute(rows):
    """(doc_id, n_shingles, component) by all shared shingles."""
    sets = []
    for doc_id, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append((doc_id, frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5
                     else frozenset([tuple(w)] if w else [])))
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, common = defaultdict(list), Counter()
    for k, (d, s) in enumerate(sets):
        if d is not None:
            for x in s:
                holders[x].append(k)
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[:i]:
                common[b, a] += 1
    for (a, b), i in common.items():
        if 100 * i >= 85 * (len(sets[a][1]) + len(sets[b][1]) - i):
            x, y = sorted((root(sets[a][0]), root(sets[b][0])))
            parent[y] = x
    return sorted(((d, len(s), root(d) if d is not None else None) for d, s in sets), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_equals_brute_force(spark, folder):
    got = minhash.near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
    assert found(got) == brute([(r["doc_id"], r["text"]) for r in table("documents", folder)])


def test_edge_rows(spark):
    got = minhash.near_duplicates(edge_frame(spark)).cache()
    assert found(got) == brute([r[:2] for r in edge_docs()])
    kept = {(r.doc_id, r.kept) for r in got.collect()}
    assert {(1, True), (2, False), (4, True), (5, True), (7, True), (8, False), (None, True)} <= kept


def test_chain_of_near_copies_is_one_component(spark):
    # neighbours are linked, ends are not; a star alone would lose links between members
    rows = [(100 - k, words(3 * k, 150 + 3 * k), "en", "a", 1) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert found(minhash.near_duplicates(df)) == brute([r[:2] for r in rows])


def test_deduplicated_keeps_all_columns_and_one_of_each_group(spark):
    df = edge_frame(spark)
    out = minhash.deduplicated(df)
    assert out.columns == df.columns
    ids = sorted((r.doc_id for r in out.collect()), key=repr)
    assert ids == sorted([1, 4, 5, 6, 7, 9, 11, None, None], key=repr)


def test_empty_table(spark):
    assert minhash.near_duplicates(empty_frame(spark)).collect() == []
    assert minhash.deduplicated(empty_frame(spark)).collect() == []


def test_estimate_corrects_for_chance(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    both = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.sort(both[:2000]), np.sort(both[1000:])
    df = spark.createDataFrame([(minhash.pack(minhash.minima(a)).tolist(), minhash.pack(minhash.minima(b)).tolist())],
                               "x array<bigint>, y array<bigint>")
    from pyspark.sql import functions as F
    got = df.select(minhash.estimated_similarity(F.col("x"), F.col("y"))).first()[0]
    assert abs(got - 1 / 3) < 0.15


def test_percent_sets_the_links(spark):
    # pairs of 0.80, 0.82, 0.85 and 0.78: the second text has d other words at its end
    def pair(k, d, n=496):
        own = [f"p{k}w{i}" for i in range(n + 4)]
        return [(10 * k, " ".join(own)), (10 * k + 1, " ".join(own[: n + 4 - d] + [f"q{i}" for i in range(d)]))]

    rows = [r for k, d in ((1, 55), (2, 49), (3, 40), (4, 62)) for r in pair(k, d)]
    sets = {i: {tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    likeness = {k: len(sets[10 * k] & sets[10 * k + 1]) / len(sets[10 * k] | sets[10 * k + 1]) for k in (1, 2, 3, 4)}
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for percent in (85, 80):
        gone = {10 * k + 1 for k, s in likeness.items() if s >= percent / 100}
        assert {r.doc_id for r in minhash.deduplicated(df, percent=percent).collect()} == {i for i, _ in rows} - gone
    assert likeness[4] < 0.8 <= likeness[1] < likeness[2] < 0.85 <= likeness[3]
    for percent in (50, 80, 85, 95):
        rows_ = minhash.band_rows(percent)
        assert (1 - (percent / 100) ** rows_) ** (minhash.HASHES // rows_) < minhash.MISSED
    assert minhash.band_rows(85) == 6 and minhash.band_rows(80) == 5 and 0.59 < minhash.estimate_cut(80) < 0.61


def template_rows(n, common, own, changed=0):
    """Documents of one template, each with words of its own, some with words of the template changed."""
    rows = []
    for k in range(n):
        shared = [f"t{i}" for i in range(common)]
        for j in range(k % (changed + 1)):
            shared[(37 * k + 101 * j) % common] = f"c{k}x{j}"
        rows.append((k, " ".join(shared + [f"d{k}x{i}" for i in range(own)])))
    return rows


@pytest.mark.parametrize("n, common, own, changed", [(300, 604, 75, 0), (120, 200, 12, 3), (80, 100, 8, 2)])
def test_templates_equal_brute_force(spark, n, common, own, changed):
    rows = template_rows(n, common, own, changed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(minhash.near_duplicates(df)) == brute(rows)


def test_documents_of_a_template_with_much_text_of_their_own_meet_nobody(spark):
    sets = minhash.shingle_sets(spark.createDataFrame(template_rows(400, 604, 75), "doc_id bigint, text string"))
    keys = minhash.with_reach(minhash.prefix_keys(sets, 85), 85)
    assert keys.count() > 400 and keys.where("reach >= n").count() == 0


def test_a_hot_key_is_split_without_losing_a_pair(spark, monkeypatch):
    rows = template_rows(90, 150, 6, 4)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    monkeypatch.setattr(minhash, "MOST_IN_TASK", 7)
    assert found(minhash.near_duplicates(df)) == want


def test_reach_bounds_the_partner():
    for percent in (80, 85, 100):
        for n in (5, 40, 679):
            for place in range(0, n, max(1, n // 9)):
                reach = (100 + percent) * (n - place) // percent - n
                for m in range(1, 2 * n):
                    common = min(n - place, m)
                    if 100 * common >= percent * (n + m - common):
                        assert m <= reach


def test_long_texts_cost_in_proportion(spark):
    import time

    def seconds(n):
        rows = [(k, " ".join(f"w{i}" for i in range(n)) + f" end{k}") for k in range(2)]
        sets = minhash.shingle_sets(spark.createDataFrame(rows, "doc_id bigint, text string")).cache()
        sets.count()
        began = time.time()
        assert minhash.prefix_keys(sets, 85).count() > 0
        return time.time() - began

    seconds(20000)
    assert seconds(160_000) < 8 * (seconds(20_000) + 0.5)


def test_nothing_is_left_in_the_shared_folder(spark):
    import os

    from shotframe.session import shared_dir
    folder = shared_dir(spark).removeprefix("file:")
    before = {f for f in os.listdir(folder) if f.startswith("minhash")}
    minhash.near_duplicates(spark.read.parquet(f"{SMALL}/documents.parquet")).count()
    assert {f for f in os.listdir(folder) if f.startswith("minhash")} == before
