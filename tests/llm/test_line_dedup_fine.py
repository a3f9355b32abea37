"""Line dedup with fine chunks against plain repeated runs of lines."""

import random

from pyspark.sql import functions as F

from rillmark.llm import line_dedup


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def repeated_lines(rows):
    """Lines in a pair of neighbours that stands before, in an earlier document or the same one."""
    pairs, n = set(), 0
    for _, text in rows:
        lines, mark = text.split("\n"), set()
        for k, pair in enumerate(zip(lines, lines[1:], strict=False)):
            mark |= {k, k + 1} if pair in pairs else set()
            pairs.add(pair)
        n += len(mark)
    return n


def test_short_passages_and_runs_of_one_line(spark):
    rnd = random.Random(5)
    own = lambda n: [f"own {rnd.random()}" for _ in range(n)]
    passages = [own(5) for _ in range(12)]
    rows = [(i, "\n".join(own(6) + rnd.choice(passages) + own(6))) for i in range(150)]
    rows += [(200 + n, "\n".join(own(3) + ["same"] * n + own(3))) for n in (4, 5, 12, 13, 180)]
    lost = {f: line_dedup.dedup_lines(docs_of(spark, rows), fine=f).agg(F.sum("n_removed_lines")).first()[0] for f in (False, True)}
    there = repeated_lines(rows)
    assert lost[True] >= 0.45 * there and lost[True] > 1.5 * lost[False] and lost[True] <= there
    out = {r.doc_id: (r.n_lines, r.n_removed_lines) for r in line_dedup.dedup_lines(docs_of(spark, rows), fine=True).where("doc_id >= 200").collect()}
    # Two lines of the first run stay, and the first three that end a run with an odd number of lines.
    assert out == {204: (10, 2), 205: (11, 2), 212: (18, 12), 213: (19, 13), 380: (186, 180)}


def test_fine_chunks_cover_every_line_once(spark):
    rnd = random.Random(6)
    rows = [(i, "\n".join(rnd.choices("aaabc", k=rnd.randint(0, 25)))) for i in range(80)] + [(90, None), (91, ""), (92, "\n" * 9)]
    for r in line_dedup.chunked(docs_of(spark, rows), fine=True).collect():
        assert r.ends == sorted(set(r.ends)) and r.ends[-1] == len(r.lines) - 1
    texts = dict(rows)
    out = line_dedup.dedup_lines(docs_of(spark, rows), fine=True).collect()
    assert len(out) == len(rows)
    assert all(r.text == (texts[r.doc_id] or "") for r in out if not r.n_removed_lines)
    assert all(r.n_lines == (texts[r.doc_id] or "").count("\n") + 1 for r in out)
