"""Two rows with one id and different texts."""

import random

import pytest
from pyspark.sql import functions as F

from rillmark.llm import decontaminate, line_dedup


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("fine", [False, True])
def test_chunks_leave_only_their_own_text(spark, fine):
    copied = "\n".join(f"line {i}" for i in range(12))
    other = "\n".join(f"other {i}" for i in range(12))
    rows = [(1, copied), (2, copied), (2, other), (2, copied)]
    out = line_dedup.dedup_lines(docs_of(spark, rows), fine=fine).collect()
    assert len(out) == 4
    assert sorted(r.text for r in out)[-2:] == sorted([copied, other])
    assert sorted((r.doc_id, r.n_removed_lines) for r in out)[:2] == [(1, 0), (2, 0)]
    assert [r.n_removed_lines for r in out if r.doc_id == 2 and r.text != other] == [max(r.n_removed_lines for r in out)] * 2


def test_chunks_whose_hashes_clash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "chunk_key", lambda body: F.xxhash64(body) % 3)
    rnd = random.Random(8)
    passages = ["\n".join(f"{rnd.random()}" for _ in range(12)) for _ in range(6)]
    rows = [(i, "\n".join([f"own {i}", rnd.choice(passages), f"end {i}", rnd.choice(passages)])) for i in range(40)]
    rows += [(None, passages[0]), (None, passages[0]), (40, rows[3][1]), (40, rows[3][1])]
    clashing = line_dedup.dedup_lines(docs_of(spark, rows)).collect()
    monkeypatch.undo()
    plain = line_dedup.dedup_lines(docs_of(spark, rows)).collect()
    order = lambda r: (r.doc_id or -1, r.text, r.n_removed_lines)
    assert sorted(clashing, key=order) == sorted(plain, key=order)
    assert sum(r.n_removed_lines for r in plain) > 200
    assert all(r.n_removed_lines == 0 for r in plain if r.doc_id is None)


def test_hits_belong_to_a_text(spark):
    item = " ".join(f"w{i}" for i in range(10))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"before {item} after"), (1, "three clean words"), (1, f"before {item} after"), (2, "clean"), (None, item)]
    out = decontaminate.decontaminate(docs_of(spark, rows), items).collect()
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in out)
    assert got == [(0, 10, 0, 0, False), (1, 3, 0, 0, False), (1, 12, 10, 1, True), (1, 12, 10, 1, True), (2, 1, 0, 0, False)]
