"""How many rows and whole sets the Jaccard join moves for pairs that it has to look at."""

import random

import brute
import pytest

from rillmark.llm import jaccard_join


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def near_copies(n, changes, size=120):
    rnd = random.Random(9)
    rows = []
    for i in range(n):
        w = [f"v{p}" for p in range(size)]
        for p in rnd.sample(range(size), changes):
            w[p] = f"n{i}-{p}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.fixture
def apart(spark):
    """Small shuffles stay in as many partitions as they are dealt to."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    own = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in own.items():
        spark.conf.set(k, v)


def test_pairs_that_meet_in_many_blocks_come_from_few(spark, folder, monkeypatch, apart):
    real, path = jaccard_join._join_leaves, folder + "/made"

    def counted(percent, best):
        over = real(percent, best)

        def run(batches):
            for batch in over(batches):
                with open(path, "a") as f:
                    f.write(f"{batch.num_rows}\n")
                yield batch

        return run

    monkeypatch.setattr(jaccard_join, "_join_leaves", counted)
    rows = near_copies(60, 2)
    out = {r.doc_id: tuple(r)[1:] for r in jaccard_join.link(docs_of(spark, rows), 4, 85).collect()}
    assert out == brute.linked(rows, 4, 85)
    with open(path) as f:
        made = sum(map(int, f))
    # Both passes over all pairs of 60 documents.
    assert 0 < made <= 2 * 60 * 59 // 2


def test_whole_sets_of_unlike_texts_stay_where_they_are(spark, monkeypatch):
    rnd = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(300))
    rows = [(i, " ".join([passage, *(f"w{rnd.randrange(10**6)}" for _ in range(6000))])) for i in range(24)]
    made, real = {}, jaccard_join.saved

    def counted(df, purpose):
        out = real(df, purpose)
        made[purpose] = made.get(purpose, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard_join, "saved", counted)
    out = jaccard_join.link(docs_of(spark, rows), 5, 80).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(i, i) for i in range(24)]
    assert made["hub-pairs"] + made["near-pairs"] + made["open-pairs"] > 20 and made["sets"] == 0


@pytest.mark.parametrize("leaf", [4, 16])
def test_leaves_of_large_blocks_lose_no_pair(spark, monkeypatch, leaf):
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    rows = near_copies(40, 3) + [(100 + i, t.replace("v1", "u1")) for i, t in near_copies(40, 4)] + [(200 + i, t) for i, t in near_copies(30, 1, 30)]
    out = {r.doc_id: tuple(r)[1:] for r in jaccard_join.link(docs_of(spark, rows), 4, 85).collect()}
    assert out == brute.linked(rows, 4, 85)


def test_rows_that_repeat_an_id_are_found_in_later_blocks(spark):
    a, b = near_copies(30, 2), near_copies(30, 1, 30)
    rows = a + [(i, t) for i, t in b if i < 8] + [(100 + i, t) for i, t in b]
    got = {}
    for r in jaccard_join.link(docs_of(spark, rows), 4, 85).collect():
        got.setdefault(r.doc_id, set()).add(r.component_id)
    # Ids 0 to 7 have texts of both groups: their links are those of both.
    single = {i: c for i, (_, c) in brute.linked([(1000 * (i >= 100) + n, t) for n, (i, t) in enumerate(rows)], 4, 85).items()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    number = [(1000 * (i >= 100) + n, i) for n, (i, _) in enumerate(rows)]
    for n, i in number:
        one, two = find(i), find(("class", single[n]))
        root[one] = two
    groups = {}
    for _, i in number:
        groups.setdefault(find(i), set()).add(i)
    assert got == {i: {min(g)} for g in groups.values() for i in g}
