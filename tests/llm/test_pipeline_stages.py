"""Stages of the pipeline on null ids and repeated rows."""

from collections import Counter

import corpus_pipeline

DOCS = "doc_id long, text string, lang string"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_exactly_one_row_of_each_text_stays(spark):
    rows = [
        (None, "only here", "a"), (None, "twice", "a"), (None, "twice", "b"), (1, "same", "a"), (1, "same", "a"),
        (2, "same", "x"), (2, "same", "b"), (None, "same", "a"), (3, "one id", "a"), (3, "other text", "a"),
        (4, None, "a"), (5, "", "a"),
    ]
    got = corpus_pipeline.one_of_equal(spark, docs_of(spark, rows), "")
    assert got.columns == ["doc_id", "text", "lang"]
    want = [(None, "only here", "a"), (None, "twice", "a"), (2, "same", "b"), (3, "one id", "a"), (3, "other text", "a"), (5, "", "a")]
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    plain = docs_of(spark, [(1, "a", "x"), (2, "a", "x"), (3, "b", "x")])
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_equal(spark, plain, "").collect()) == [2, 3]


def test_benchmark_text_goes_without_an_id(spark, folder):
    item = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(None, f"x {item} y", "a"), (None, "clean", "a"), (7, item, "a"), (7, "clean too", "a"), (8, None, "a")]
    got = corpus_pipeline.without_benchmark(spark, docs_of(spark, rows), folder)
    assert Counter(tuple(r) for r in got.collect()) == Counter([(None, "clean", "a"), (7, "clean too", "a"), (8, None, "a")])


def test_near_duplicates_of_a_shared_id_take_no_other_text_with_them(spark):
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, words, "en"), (2, words + " more", "en"), (2, "a text that is like no other one here at all", "en"), (3, words + " extra", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = sorted((r.doc_id, r.text) for r in corpus_pipeline.one_of_near(spark, docs, "").collect())
    assert kept == sorted((i, t) for i, t, _ in rows[:3])
