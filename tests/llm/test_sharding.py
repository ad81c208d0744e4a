import random
import zlib
from collections import Counter, defaultdict

from common import MIDDLE, edge_docs, edge_frame, empty_frame, table
from pyspark.sql import functions as F
from shotframe.llm import sharding
from shotframe.llm.queries import op5_shards


def gapless(pairs):
    by = defaultdict(list)
    for shard, slot in pairs:
        by[shard].append(slot)
    return all(sorted(v) == list(range(len(v))) for v in by.values())


def test_near_equal_bytes(spark):
    rows = op5_shards(spark, MIDDLE).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in table("documents", MIDDLE)}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in docs.items()}
    assert gapless((r.shard, r.slot) for r in rows)
    sums = Counter()
    for r in rows:
        sums[r.shard] += r.size
    assert set(sums) == set(range(8))
    largest = max(r.size for r in rows)
    assert max(sums.values()) - min(sums.values()) <= 2 * largest
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)


def test_hot_text_is_split_and_small_groups_stay(spark):
    hot = [(k, "same text " * 20) for k in range(3000)]
    rest = [(10_000 + k, f"text number {k // 2} " * 15) for k in range(6000)]
    out = sharding.sharded(spark.createDataFrame(hot + rest, "doc_id bigint, text string"), 8).collect()
    sums = Counter()
    places = defaultdict(set)
    for r in out:
        sums[r.shard] += len(r.text) + 1
        if r.doc_id >= 10_000:
            places[r.text].add(r.shard)
    assert max(sums.values()) < 1.02 * min(sums.values())
    assert all(len(p) == 1 for p in places.values())
    assert gapless((r.shard, r.slot) for r in out)


def test_pieces_do_not_change_shards(spark):
    df = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    one = {r.doc_id: r.shard for r in sharding.sharded(df).collect()}
    out = sharding.sharded(df, piece_bytes=10_000).collect()
    assert one == {r.doc_id: r.shard for r in out}
    assert gapless((r.shard, r.slot) for r in out)


def test_edge_rows(spark):
    out = sharding.sharded(edge_frame(spark), 3).collect()
    assert len(out) == len(edge_docs())
    assert gapless((r.shard, r.slot) for r in out)
    assert sharding.sharded(empty_frame(spark)).collect() == []


def test_place_in_constant_bounds(spark):
    bounds = [(k * 7, k) for k in range(300)]
    df = spark.range(2200).select((F.col("id") - 20).alias("h"), F.lit(50).cast("bigint").alias("d"))
    for r in df.withColumn("p", sharding.place_in(F.col("h"), F.col("d"), bounds)).collect():
        assert r.p == sum(b <= (r.h, r.d) for b in bounds)


def test_columns_of_any_name_stay(spark):
    names = ("row", "h", "d", "_h", "_d", "piece", "rank", "begin", "n", "a.b", "part", "size")
    df = edge_frame(spark).withColumns({c: F.lit(k) for k, c in enumerate(names)})
    out = sharding.sharded(df, 3)
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    assert out.columns == kept + ["shard", "slot"]
    assert all([r[c] for c in names] == list(range(len(names))) for r in out.collect())


def plain_splitters(rows, shards):
    """Running sums over all keys in order."""
    total, at, sums = sum(s for *_, s in rows), 0, {}
    for h, d, s in rows:
        sums[h, d] = sums.get((h, d), 0) + s
    out = []
    targets = [total * k // shards for k in range(1, shards)]
    for key in sorted(sums):
        while len(out) < len(targets) and at + sums[key] > targets[len(out)]:
            out.append(key)
        at += sums[key]
    return out


def test_subdivided_ranges_give_the_exact_splitters(spark, monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(sharding, "WHOLE_SHARE", 0.0)
    rows = [(rng.randrange(-50, 50), rng.randrange(-10**6, 10**6), rng.randint(1, 200)) for _ in range(4000)]
    rows += [(7, 7, 90)] * 1500 + [(7, 8, 1)] * 40
    for data, most in ((rows, 60), (rows, 100_000), (rows[:5], 1), ([(1, 1, 5)] * 30, 4), ([(1, 2**63 - 1, 5)] * 30 + [(2, -(2**63), 1)], 1)):
        df = spark.createDataFrame(data, "h bigint, d bigint, size bigint").coalesce(2).cache()
        assert sharding.splitters(df, 4, ranges=16, draws=5, most_in_range=most) == plain_splitters(data, 4), (len(data), most)


def test_every_range_in_order_is_small(spark, monkeypatch):
    seen = []
    subdivided = sharding._subdivided
    monkeypatch.setattr(sharding, "_subdivided", lambda *a: seen.append(a[1]) or subdivided(*a))
    df = spark.range(30_000).select(F.xxhash64("id").alias("h"), F.col("id").alias("d"), F.lit(3).cast("bigint").alias("size"))
    sharding.splitters(df, 4, ranges=8, draws=20, most_in_range=200)
    assert len(seen) > 3 and all(r.rows > 200 for r in seen)
