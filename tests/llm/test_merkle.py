"""Merkle manifests against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rillmark.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string, h string, rank int, tree string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, more=0):
    i, source, lang, n, text = row
    values = (i, source, lang, None if n is None else n + more, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(hashes):
    """The root, and of every leaf the steps (side, sibling) to it."""
    paths, level, places = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
    while len(level) > 1:
        for at, p in enumerate(places):
            other = p ^ 1
            paths[at].append(("L" if p % 2 else "R", level[other] if other < len(level) else ""))
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        places = [p // 2 for p in places]
    return level[0], paths


def plain(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    own = {}
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        own[name] = climb([leaf(r) for r in trees[name]])
    root, above = climb([own[n][0] for n in names])
    out = []
    for name, up in zip(names, above, strict=True):
        for row, path in zip(trees[name], own[name][1], strict=True):
            steps = path + up
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            h = leaf(row, int(bad))
            for side, other in steps:
                h = sha(other + h if side == "L" else h + other)
            out.append((row[0], leaf(row), own[name][0], root, sha("".join(s for _, s in steps)), h, h == root))
    return sorted(out, key=repr)


def shown(spark, rows):
    df = spark.createDataFrame([(*r, "x", 7, "y") for r in rows], DOCS).repartition(3)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    out = merkle.manifest(df, tampered, {"n_chars": F.col("n_chars") + 1})
    return sorted((tuple(r) for r in out.collect()), key=repr)


def some(n, lang):
    return [(i * 3 + len(lang or ""), f"s{i % 4}", lang, i, f"text {i}") for i in range(n)]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 4)


CASES = {
    "one": some(1, "en"),
    "many trees of any size": some(33, "en") + some(1, "de") + some(5, "fr") + some(16, None) + some(2, "") + some(17, "é"),
    "nulls, empty, very long": [
        (None, None, None, None, None), (None, "s", "en", 1, "a"), (1, "", "en", None, ""), (2, None, "en", 4, "x" * 300_000),
        (7, "é:", "-", -5, "0:"), (49, "s", "en", None, None),
    ],
    "repeated rows and ids": [(4, "s", "en", 1, "a")] * 11 + [(4, "s", "en", 1, "b"), (5, "s", "en", 2, "a")] * 3,
}


@pytest.mark.parametrize("name", CASES)
def test_against_a_plain_tree(spark, small_blocks, name):
    assert shown(spark, CASES[name]) == plain(CASES[name])


def test_blocks_of_full_size(spark):
    rows = some(1500, "en") + some(3, None)
    assert shown(spark, rows) == plain(rows)


def test_without_rows_and_without_tampering(spark, small_blocks):
    assert shown(spark, []) == []
    df = spark.createDataFrame([(*r, "x", 7, "y") for r in CASES["one"]], DOCS)
    assert [r.verified for r in merkle.manifest(df).collect()] == [True]


def test_ranks_of_equal_rows_have_no_gaps(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)] * 3, "tree string, x int").repartition(5)
    got = merkle.ranked(df, "tree", ["x"]).collect()
    assert sorted(r["rank"] for r in got if r.tree == "a") == list(range(50))
    assert sorted(r["rank"] for r in got if r.tree == "b") == [0, 1, 2]
    assert {(r.tree, r["size"]) for r in got} == {("a", 50), ("b", 3)}
