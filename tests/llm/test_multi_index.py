"""The inverted multi-index against comparing everything with everything."""

import math
import os

import numpy as np
import pytest
from oracle import connect

from rillmark.llm import multi_index
from rillmark.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SCHEMA = "vec_id long, embedding array<double>, cell int, shard string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "k") for i, v in rows], SCHEMA).repartition(3)


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


def nearest(rows, queries, k):
    out = {}
    for q in queries:
        best = {}
        for i, v in rows:
            if i != q[0]:
                best[i] = max(best.get(i, -2), round(cosine(q[1], v), 12))
        out[q[0]] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(spark, rows, asked, k=5, recall=1.0):
    df = table(spark, rows)
    out = multi_index.search(multi_index.build(df), table(spark, asked), k, recall).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        mine = got.setdefault(r.query_id, [])
        assert r["rank"] == len(mine) + 1
        mine.append((r.vec_id, round(r.score, 12)))
    return got


def clustered(n, size, seed=0, centers=12):
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(size=(centers, size))
    rows = middle[rnd.integers(centers, size=n)] + 0.2 * rnd.normal(size=(n, size))
    return [(i, v.tolist()) for i, v in enumerate(rows)]


@pytest.mark.parametrize("size", [1, 2, 3, 9])
def test_whole_walks_are_exact(spark, size):
    rows = clustered(150, size) if size > 1 else [(i, [float(i % 7 - 3) or 1.0]) for i in range(40)]
    asked = rows[::10]
    got = found(spark, rows, asked)
    want = nearest(rows, asked, 5)
    assert {q: [s for _, s in v] for q, v in got.items()} == {q: [s for _, s in v] for q, v in want.items()}
    assert got == want


def test_recall_on_clusters_with_a_short_walk(spark):
    rows = clustered(3000, 16, 4)
    asked = rows[::25]
    df = table(spark, rows)
    index = multi_index.build(df)
    enough = multi_index.enough_entries(index, multi_index.sound(table(spark, asked)), 5, 0.95)
    assert enough < 0.5 * index.size
    got = {(r.query_id, r.vec_id) for r in multi_index.search(index, table(spark, asked), 5).collect()}
    want = {(q, i) for q, v in nearest(rows, asked, 5).items() for i, _ in v}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_copies_and_ties_go_to_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "SHARD_ROWS", 8)  # the copies fill many shards
    same = [0.3, -0.1, 0.7, 0.2]
    rows = [(i, same) for i in range(100, 160)] + [(i, [2 * x for x in same]) for i in range(30, 40)] + clustered(25, 4, 7)
    asked = [(i, v) for i, v in rows if i % 5 == 0]
    assert found(spark, rows, asked) == nearest(rows, asked, 5)


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 0.0]), (2, [1e-300, 1e-300]), (3, [1e300, -1e300]), (4, [0.0, -2.0]), (5, [1.0, 1e-9])]
    odd = [(6, None), (7, []), (8, [0.0, 0.0]), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [None, 1.0]), (12, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    got = found(spark, good + odd, good + odd)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {
        1: [5, 2, 3, 4], 2: [5, 1, 3, 4], 3: [1, 4, 5, 2], 4: [3, 1, 5, 2], 5: [1, 2, 3, 4],
    }


def test_one_id_with_several_vectors_and_few_candidates(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [1.0, 0.1]), (2, [1.0, 0.1]), (3, [-1.0, 0.0])]
    got = found(spark, rows, rows[:1])
    assert [i for i, _ in got[1]] == [2, 3] and got[1][0][1] == round(cosine([1.0, 0.0], [1.0, 0.1]), 12)
    assert found(spark, rows[:1], rows[:1]) == {}


def test_without_rows_or_queries(spark):
    empty = table(spark, [])
    assert multi_index.build(empty) is None
    assert multi_index.search(None, empty).count() == 0
    rows = clustered(20, 4)
    assert found(spark, rows, []) == {}


def test_the_walk_rises_and_stops():
    rnd = np.random.default_rng(3)
    left, right = rnd.random(7), rnd.random(9)
    counts = rnd.integers(0, 4, 63)
    sums = (left[:, None] + right).ravel()
    order = [int(c) for c in np.argsort(sums, kind="stable") if counts[c]]
    assert multi_index.walk(left, right, counts, 10**9) == order
    some = multi_index.walk(left, right, counts, 20)
    assert some == order[: len(some)] and counts[some].sum() >= 20 > counts[some[:-1]].sum()


def test_large_cells_are_cut_and_small_ones_share():
    counts = np.array([3, 50, 0, 4, 4, 4])
    plan = multi_index.deal(counts, rows=10)
    assert plan.slices.tolist() == [1, 5, 1, 1, 1, 1]
    assert plan.first.tolist() == [0, 1, 6, 6, 6, 7]
    assert set(plan.shard(np.full(500, 1), np.arange(500)).tolist()) == {1, 2, 3, 4, 5}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_recall_of_the_query(spark):
    rows = connect(SF_DIR).execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, unit = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    at = np.flatnonzero(ids % 50 == 0)
    near = unit[at] @ unit.T
    near[np.arange(len(at)), at] = -2
    want = {(int(ids[q]), int(ids[i])) for q, row in zip(at, np.argsort(-near, axis=1)[:, :5], strict=True) for i in row}
    out = QUERIES["op11_multi_index"].run(spark, SF_DIR).collect()
    got = {(r.query_id, r.vec_id) for r in out}
    place = {int(i): n for n, i in enumerate(ids)}
    assert all(abs(r.score - unit[place[r.query_id]] @ unit[place[r.vec_id]]) < 1e-12 for r in out)
    assert len(got) == len(out) == 5 * len(at) and len(got & want) >= 0.9 * len(want)
