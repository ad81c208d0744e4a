import hashlib
import random

import duckdb
import numpy as np
import pytest
from common import MIDDLE
from pyspark.sql import functions as F
from shotframe.llm import codes, gnat
from shotframe.llm.queries import oracle_sql, op11_codes


def plain(points, queries):
    squares = ((queries[:, None, :] - points[None]) ** 2).sum(axis=2)
    return squares.argmin(axis=1), squares.min(axis=1)


@pytest.mark.parametrize("n, width, spread", [(1, 3, 50), (4, 2, 5), (5, 2, 3), (16, 8, 2000), (16, 2, 4), (200, 4, 300), (16, 1, 2)])
def test_tree_finds_what_plain_search_finds(n, width, spread):
    rng = np.random.default_rng(n * width)
    points = rng.integers(-spread, spread + 1, (n, width))
    queries = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (2000, width)), points, points])
    index, square = gnat.Search(points).nearest(queries)
    wanted = plain(points, queries)
    assert (index == wanted[0]).all() and (square == wanted[1]).all()


def test_equal_points_and_clusters_that_are_left_out():
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, (4, 8))
    points = (centres[rng.integers(0, 4, 64)] + rng.integers(-30, 30, (64, 8)))
    points[40:44] = points[7]
    queries = points[rng.integers(0, 64, 3000)] + rng.integers(-20, 20, (3000, 8))
    search = gnat.Search(points)
    index, square = search.nearest(queries)
    wanted = plain(points, queries)
    assert (index == wanted[0]).all() and (square == wanted[1]).all()
    assert search.looked < 0.6 * len(queries) * len(points)
    same = gnat.Search(np.zeros((9, 2), np.int64))
    assert same.nearest(np.ones((5, 2), np.int64))[0].tolist() == [0] * 5


def test_roots_are_exact():
    x = np.array([0, 1, 2, 3, 4, 24, 25, 26, 2**52 - 1, (2**31 - 1) ** 2, (2**31 - 1) ** 2 - 1, (2**31 - 1) ** 2 + 1])
    low, high = gnat.root_below(x), gnat.root_above(x)
    for v, a, b in zip(x.tolist(), low.tolist(), high.tolist()):
        assert a * a <= v < (a + 1) ** 2 and (b - 1) ** 2 < max(v, 1) <= b * b or v == 0 == a == b


def by_hand(rows, parts=8, entries=16, rounds=6):
    """The contract in plain Python integers."""
    kept = [(i, lab, [int(np.floor(4096 * float(x))) for x in v]) for i, lab, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    w = len(kept[0][2]) // parts
    first = sorted({(i, tuple(v)) for i, _, v in kept})[:entries]
    books = [[list(v[p * w: (p + 1) * w]) for _, v in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, _, v in kept:
                own.setdefault(nearest(p, v[p * w: (p + 1) * w])[1], []).append(v[p * w: (p + 1) * w])
            for k, vs in own.items():
                books[p][k] = [sum(c) // len(vs) for c in zip(*vs)]
    out, sums = [], {}
    for i, lab, v in kept:
        near = [nearest(p, v[p * w: (p + 1) * w]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in near), sum(s for s, _ in near)))
        sums[lab] = sums.get(lab, 0) + out[-1][3]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((i, c, e, sums[lab], sha) for i, lab, c, e in out)


SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.mark.parametrize("n, dim", [(70, 16), (5, 8), (40, 24)])
def test_equals_the_contract_by_hand(spark, n, dim):
    rng = random.Random(n)
    rows = [(3 * i, [float(np.float32(rng.uniform(-1, 1))) for _ in range(dim)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [(1000, None, 1), (1, [None] * dim, 1), (2, [float("nan")] + [0.0] * (dim - 1), 1),
             (4, [float("-inf")] + [0.0] * (dim - 1), 2), (2000, rows[0][1], None), (2000, rows[0][1], None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(
        {c: F.lit(k) for k, c in enumerate(("id", "vector", "code", "error", "_l", "total"))})
    got = sorted(tuple(r) for r in codes.compressed(df).collect())
    assert got == by_hand([(i, lab, v) for i, v, lab in rows])


def test_edge_rows(spark):
    assert codes.compressed(spark.createDataFrame([], SCHEMA)).collect() == []
    odd = [(1, [0.5] * 8, 1), (None, [0.25] * 8, None), (3, [0.5] * 16, 1), (4, [], 2), (5, [0.1] * 8, None), (5, [0.1] * 8, None)]
    out = {(r.vec_id, r.code is None) for r in codes.compressed(spark.createDataFrame(odd, SCHEMA)).collect()}
    assert out == {(1, False), (None, False), (3, True), (4, True), (5, False)}
    only = spark.createDataFrame([(None, [0.5] * 8, 1)], SCHEMA)
    assert [(r.vec_id, r.code) for r in codes.compressed(only).collect()] == [(None, None)]
    empty = spark.createDataFrame([(1, [], 1)], SCHEMA)
    assert [(r.vec_id, r.code) for r in codes.compressed(empty).collect()] == [(1, None)]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{MIDDLE}/embeddings.parquet'")
    wanted = con.execute(oracle_sql()["op11_codes"]).fetchall()
    got = op11_codes(spark, MIDDLE).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(wanted) and len(got) == 500
