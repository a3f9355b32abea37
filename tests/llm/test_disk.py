"""What the Jaccard join and the steps it shares leave on disk, and how many pairs it writes."""

import os
import random
import time

import brute
import numpy as np
from test_near_pairs import docs_of, near_copies

from rillmark.llm import common, jaccard_join


def shuffle_files(spark):
    scala = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (scala.apply(i).getName() for i in range(scala.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_what_was_shuffled_goes_once_rows_are_written(spark):
    before = shuffle_files(spark)
    out = common.saved(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counts")
    assert sum(r["count"] for r in out.collect()) == 1000
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left


def test_tables_between_the_steps_go(spark, folder, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _, purpose: f"{folder}/{purpose}-{random.randrange(10**12)}")
    rows = near_copies(30, 2) + [(100 + i, t) for i, t in near_copies(12, 3, 30)]
    out = {r.doc_id: tuple(r)[1:] for r in jaccard_join.link(docs_of(spark, rows), 4, 85).collect()}
    assert out == brute.linked(rows, 4, 85)
    left = {name.rpartition("-")[0] for name in os.listdir(folder)}
    assert left <= {"members", "links", "small-star", "hub-components", "component-links", "upper-components", "components"}


def test_unlike_long_texts_of_a_block_make_no_pairs(spark, folder, monkeypatch):
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
    rnd = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(600))
    rows = [(i, " ".join([passage, *(f"w{rnd.randrange(10**6)}" for _ in range(6000))])) for i in range(24)]
    out = jaccard_join.link(docs_of(spark, rows), 5, 80).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(i, i) for i in range(24)]
    with open(path) as f:
        made = [int(x) for x in f]
    # Blocks of all 24 were looked at; in 64 groups each of their 276 pairs stayed open.
    assert made and sum(made) == 0


def test_points_bound_every_overlap():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 30, 394, 1000, 1700, 5000, 9000)]
    sets += [np.unique(np.concatenate([s[: len(s) * 4 // 5], rnd.integers(0, 1 << 63, len(s) // 5 + 1).astype(np.uint64)])) for s in sets]
    # All in one group: far beyond what half a byte counts.
    sets += [np.arange(a, b, dtype=np.uint64) << np.uint64(20) for a, b in ((1, 5000), (100, 7000))]
    points = jaccard_join.Points([jaccard_join._point(s) for s in sets])
    coarse = points.coarse()
    assert coarse.sum(axis=1).tolist() == [len(s) for s in sets]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    rest = [s[(s & np.uint64(63)) >= jaccard_join.SLICE] for s in sets]
    for x, y, most, most_rest in zip(i, j, jaccard_join.bounds(points, i, points, j), jaccard_join.bounds(points, i, points, j, jaccard_join.SLICE), strict=True):
        assert len(np.intersect1d(sets[x], sets[y])) <= most <= np.minimum(coarse[x], coarse[y]).sum()
        assert len(np.intersect1d(rest[x], rest[y])) <= most_rest <= most
        assert x != y or most == len(sets[x])
