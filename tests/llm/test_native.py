"""Exact dedup, sharding, line dedup and decontamination on small tables."""

import random
import uuid
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from rillmark.llm import decontaminate, exact_dedup, line_dedup, sharding

DOCS = "doc_id long, text string, digest string, n int, bucket int"


def docs_of(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS).repartition(3)


def index_of(spark, folder, name=None):
    return exact_dedup.DigestIndex.open(spark, name or f"t_{uuid.uuid4().hex}", f"{folder}/index", 4)


def test_exact_dedup_keeps_the_largest_id(spark, folder):
    rows = [(1, "a"), (2, "a"), (3, ""), (4, None), (5, "b"), (6, "a"), (7, "long " * 50_000)]
    out = exact_dedup.dedup(docs_of(spark, rows), index_of(spark, folder), "one")
    assert {r.doc_id: tuple(r)[1:] for r in out.collect()} == brute.exact(rows)


def test_exact_dedup_over_batches_and_repeats(spark, folder):
    index = index_of(spark, folder)
    first, second = [(1, "a"), (2, "b"), (3, "b")], [(4, "b"), (5, "c"), (6, "c")]
    for _ in range(2):  # a batch run again decides the same and adds nothing
        one = exact_dedup.dedup(docs_of(spark, first), index, "one").collect()
        assert {r.doc_id for r in one if r.kept} == {1, 3}
    two = exact_dedup.dedup(docs_of(spark, second), index, "two").collect()
    assert {r.doc_id: (r.keep_id, r.kept) for r in two} == {4: (3, False), 5: (6, False), 6: (6, True)}
    assert index.entries().count() == 3
    again = index_of(spark, folder, f"t_{uuid.uuid4().hex}")  # the files outlive the table's name
    assert again.entries().count() == 3


def test_index_is_not_shuffled(spark, folder, capsys):
    index = index_of(spark, folder)
    index.append(spark.createDataFrame([(bytearray(b"x"), 1, "a")], exact_dedup.ENTRY))
    new = spark.createDataFrame([(bytearray(b"y"),)], "digest binary").repartition(4, "digest")
    new.join(index.entries().hint("merge"), "digest", "left_anti").explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_exact_dedup_null_id_repeated_rows_and_nothing(spark, folder):
    rows = [(None, "a"), (1, "a"), (None, "z"), (2, "q"), (2, "q")]
    got = Counter((r.doc_id, r.keep_id, r.kept) for r in exact_dedup.dedup(docs_of(spark, rows), index_of(spark, folder), "b").collect())
    assert got == Counter([(None, 1, False), (1, 1, True), (None, None, True), (2, 2, True), (2, 2, True)])
    assert exact_dedup.dedup(docs_of(spark, []), index_of(spark, folder), "c").count() == 0


@pytest.mark.parametrize("total", [0, 1, 7, 803])
def test_shards_are_even_and_slots_gapless(spark, total):
    texts = ["", None, "é" * 9, "same"]
    rows = [(i, texts[i % 4]) for i in range(total)]
    out = sharding.assign(docs_of(spark, rows), shards=8, points=16, bucket_rows=7).collect()
    assert sorted(r.doc_id for r in out) == list(range(total))
    slots = defaultdict(list)
    for r in out:
        data = (rows[r.doc_id][1] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_with_slack_follow_the_ring(spark):
    rows = [(i, "x") for i in range(4000)]
    nodes = sharding.ring(4, 64)
    out = {r.doc_id: r.shard for r in sharding.assign(docs_of(spark, rows), shards=4, points=64, slack=0.25).collect()}
    assert max(Counter(out.values()).values()) <= 1250
    places = {r.id: r.p for r in spark.range(4000).select("id", F.shiftrightunsigned(F.xxhash64("id"), 1).alias("p")).collect()}
    own = {i: next((s for q, s in nodes if q >= p), nodes[0][1]) for i, p in places.items()}
    assert sum(out[i] == own[i] for i in out) > 3600
    grown = {r.doc_id: r.shard for r in sharding.assign(docs_of(spark, rows), shards=5, points=64, slack=0.25).collect()}
    assert sum(out[i] != grown[i] for i in out) < 1800


def test_shards_take_null_and_repeated_ids(spark):
    rows = [(None, f"t{i}") for i in range(40)] + [(5, "x")] * 40
    out = sharding.assign(docs_of(spark, rows), shards=8, points=4, bucket_rows=5).collect()
    assert sorted(Counter(r.shard for r in out).values()) == [10] * 8


def test_cells_cover_the_ring():
    nodes = sharding.ring(3, 5)
    end = -1
    for _, low, high, arc in sharding.cells(nodes):
        assert low == end + 1 and high >= low
        after = [k for k, (p, _) in enumerate(nodes) if p >= high]
        assert arc == (after[0] if after else 0)
        end = high
    assert end == (1 << sharding.RING_BITS) - 1


def chunks_of(text):
    lines = (text or "").split("\n")
    import hashlib

    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % line_dedup.PRIME for x in lines]
    at = lambda k: h[k] if k >= 0 else 0
    r = [((at(i - 2) * line_dedup.BASE % line_dedup.PRIME + at(i - 1)) * line_dedup.BASE + h[i]) % line_dedup.PRIME for i in range(len(h))]
    ends = [i for i in range(len(r)) if i == len(r) - 1 or (i and r[i] < r[i - 1] and r[i] <= r[i + 1])]
    return [lines[a + 1 : b + 1] for a, b in zip([-1, *ends], ends, strict=False)]


def test_line_dedup_against_brute_force(spark):
    rnd = random.Random(2)
    block = [[f"line {rnd.random()}" for _ in range(12)] for _ in range(4)]
    rows = []
    for i in range(60):
        lines = [f"own {rnd.random()}" for _ in range(rnd.randint(0, 4))] + rnd.choice(block)[rnd.randint(0, 3) :]
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n\n"), (103, "x\n" * 2000), (104, "x\n" * 2000), (None, rows[0][1])]
    seen, want = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        kept, gone = [], 0
        for chunk in chunks_of(text):
            key = "\n".join(chunk)
            if len(chunk) > 1 and key in seen and i is not None:
                gone += 1
            else:
                kept += chunk
            if len(chunk) > 1:
                seen.add(key)
        want[i] = ("\n".join(kept), gone)
    out = line_dedup.dedup_lines(docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.text, r.n_removed_chunks) for r in out} == want
    assert sum(r.n_removed_lines for r in out) > 100
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


def test_chunk_bounds_resist_shifts():
    lines = [f"line {i}" for i in range(200)]
    one, two = chunks_of("\n".join(lines)), chunks_of("\n".join(["new", *lines]))
    assert one[3:] == two[-len(one) + 3 :]


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item"), (3, None), (4, " - "), (10, "two three four five six seven eight nine ten eleven"), (None, "nameless words here")]


def items_of(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_decontamination_against_brute_force(spark):
    rnd = random.Random(4)
    words = "one two three four five six seven eight nine ten eleven twelve".split()
    rows = []
    for i in range(80):
        a, b = sorted((rnd.randint(0, 12), rnd.randint(0, 12)))
        text = [*rnd.choices(words, k=rnd.randint(0, 6)), *words[a:b], *rnd.choices([*words, "short", "ITEM"], k=9)]
        rows.append((i, rnd.choice([" ", ", ", "\n"]).join(text).upper() if i % 3 else " ".join(words * 2)))
    rows += [(90, None), (91, ""), (92, "..."), (93, "short item"), (94, "é short é"), (95, ".short-item short item."), (96, "the " * 30_000 + "short item")]
    named = [x for x in ITEMS if x[0] is not None]
    out = decontaminate.decontaminate(docs_of(spark, rows), items_of(spark).where("item_id IS NOT NULL"))
    assert {r.doc_id: tuple(r)[1:] for r in out.collect()} == brute.contaminated(rows, named)


def test_decontamination_without_names_ids_or_rows(spark):
    rows = [(1, "nameless words here"), (None, "short item"), (2, "clean")]
    out = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.decontaminate(docs_of(spark, rows), items_of(spark)).collect()}
    assert out == {1: (3, 3, 0, True), None: (2, 0, 0, False), 2: (1, 0, 0, False)}
    nothing = items_of(spark).limit(0)
    assert not any(r.contaminated for r in decontaminate.decontaminate(docs_of(spark, rows), nothing).collect())
    assert decontaminate.decontaminate(docs_of(spark, []), items_of(spark)).count() == 0


def test_postings_beyond_the_broadcast(spark, monkeypatch):
    rows = [(1, "a short item b"), (2, "none")]
    want = {r.doc_id: tuple(r) for r in decontaminate.decontaminate(docs_of(spark, rows), items_of(spark)).collect()}
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert {r.doc_id: tuple(r) for r in decontaminate.decontaminate(docs_of(spark, rows), items_of(spark)).collect()} == want


def test_proximity(spark):
    rows = [(1, "alpha x x beta"), (2, "beta alpha"), (3, "alpha " + "x " * 40 + "beta"), (4, "alpha")]
    terms = spark.createDataFrame([("alpha",), ("beta",)], "term string")
    phrases = spark.createDataFrame([(["alpha", "beta"],)], "phrase array<string>")
    index = decontaminate.postings(docs_of(spark, rows), terms, 2, 1)
    assert {r.doc for r in decontaminate.proximity_matches(index, phrases, 5).collect()} == {1, 2}
