"""The registered training-data queries on the smallest tables, and the pipeline against brute force."""

import os

import brute
import corpus_pipeline
import pytest
from oracle import connect, difference

import __spark_entry__ as entry
from rillmark.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontamination", "byte_bpe"]


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_against_sql(spark, name):
    assert difference(QUERIES[name].run(spark, SF_DIR), connect(SF_DIR), QUERIES[name].sql) is None


@pytest.fixture(scope="module")
def docs():
    return connect(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall()


def test_suffix_dedup(spark, docs):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_suffix_dedup"].run(spark, SF_DIR).collect()}
    assert got == brute.covered(docs)


def test_jaccard_join(spark, docs):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op7_jaccard_join"].run(spark, SF_DIR).collect()}
    assert got == brute.linked(docs, 4, 85)


def test_language_id_on_held_out_documents(spark):
    out = QUERIES["op3_language_id"].run(spark, SF_DIR).collect()
    langs = dict(connect(SF_DIR).execute("SELECT doc_id, lang FROM documents").fetchall())
    held = [r for r in out if r.held_out]
    assert len(out) == len(langs) and held
    assert sum(langs[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def test_chats_and_shards_return_every_row(spark, docs):
    n = connect(SF_DIR).execute("SELECT count(*) FROM conversations").fetchone()[0]
    assert QUERIES["op8_chat_tools"].run(spark, SF_DIR).count() == n
    assert QUERIES["op6_sharding"].run(spark, SF_DIR).count() == len(docs)


def test_pipeline_against_brute_force(spark, docs):
    items = connect(SF_DIR).execute("SELECT item_id, text FROM benchmark").fetchall()
    named = corpus_pipeline.known_language(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR)
    left = dict(docs)
    left = {r.doc_id: left[r.doc_id] for r in named.collect()}
    assert len(left) >= 0.98 * len(docs)
    kept = brute.exact(left.items())
    left = {i: t for i, t in left.items() if kept[i][2]}
    near = brute.linked(left.items(), corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.LEAST_PERCENT)
    left = {i: t for i, t in left.items() if near[i][1] == i}
    leaked = brute.contaminated(left.items(), items)
    left = {i: t for i, t in left.items() if not leaked[i][4]}
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.decoded_sha256 for r in out} == {i: brute.sha(t) for i, t in left.items()}
