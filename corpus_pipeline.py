"""A training corpus in five stages, each over all that the one before it kept.

Language ID, exact dedup, near-duplicate classes, benchmark decontamination,
and byte-level BPE. Every stage but the last returns the columns of documents.
Stages are written and read again, so a lost executor never reaches back past
the stage it works on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm import byte_bpe, decontaminate, exact_dedup, jaccard_join, language_id
from rillmark.llm.common import bounded_broadcast, saved, saved_in_small_batches
from rillmark.plans.catalog.inputs import read
from rillmark.session import shared_dir, use_utc

#: A text this far from every profile is in none of the languages learned.
LEAST_SCORE = 0.2
#: Near duplicates share this percentage of their five-word shingles.
SHINGLE_WORDS, LEAST_PERCENT = 5, 80
#: Keys of texts broadcast at most.
MANY_TEXTS = 100_000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts unlike every language learned."""
    profiles = language_id.learn(read(spark, sf_dir, "documents").where(language_id.learnable()))
    named = language_id.predict(docs, profiles)
    return named.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def text_key(docs: DataFrame) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts exactly one row stays, that with the largest id; a text whose rows have no id keeps one, too.

    Of rows that share text and id the smallest stays, by all columns.
    """
    path = shared_dir(spark, "pipeline-digests")
    index = exact_dedup.DigestIndex.open(spark, f"pipeline_digests_{uuid.uuid4().hex}", path)
    kept = exact_dedup.dedup(docs, index, "pipeline").where("kept")
    stays = saved(
        kept.groupBy("text_sha256").agg(F.max("doc_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
        .select(F.unhex("text_sha256").alias("_text"), "_id", "_n"),
        "pipeline-stays",
    )
    keyed = docs.withColumn("_key", text_key(docs))
    same = (F.col("_key") == F.col("_text")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    single = keyed.join(stays.where("_n = 1"), same, "left_semi").select(*docs.columns)
    many = stays.where("_n > 1")
    n_many = many.count()
    if not n_many:
        return single
    repeated = keyed.join(bounded_broadcast(many, n_many, MANY_TEXTS), same, "left_semi")
    one = repeated.groupBy("_key").agg(F.min(F.struct(*docs.columns)).alias("_row"))
    return single.unionByName(one.select("_row.*"))


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays.

    A document without id is in no class and stays, and so do the documents of
    an id that several have: a class is known by ids, and it may be another of
    them that is a near duplicate.
    """
    classes = jaccard_join.link(docs, SHINGLE_WORDS, LEAST_PERCENT)
    gone = classes.where("component_id <> doc_id").select("doc_id").distinct()
    several = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("doc_id")
    return docs.join(gone.join(several, "doc_id", "left_anti"), "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words of a benchmark item in a row go, with or without an id."""
    keyed = docs.withColumn("_key", text_key(docs))
    # Equal texts get equal verdicts, so the text is the key; the stages before leave each text once.
    marked = decontaminate.decontaminate(keyed, read(spark, sf_dir, "benchmark"), id_col="_key")
    gone = marked.where("contaminated").select("_key").distinct()
    return keyed.join(gone, "_key", "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and checksums of the ids and of the decoded text."""
    digests = byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return saved_in_small_batches(digests, "token-digests")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("exact_dedup", one_of_equal),
    ("jaccard_join", one_of_near),
    ("decontamination", without_benchmark),
    ("byte_bpe", tokens),
]

#: Language profiles and BPE merges are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    use_utc(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
