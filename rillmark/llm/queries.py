"""The registered queries of the training-data operators, one per operator, and the pipeline."""

from __future__ import annotations

import uuid

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm import (
    alignment,
    byte_bpe,
    chat_tools,
    decontaminate,
    exact_dedup,
    jaccard_join,
    language_id,
    line_dedup,
    merkle,
    multi_index,
    sharding,
    suffix_dedup,
    warc,
)
from rillmark.plans.catalog.inputs import Query, read
from rillmark.session import shared_dir


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    known = language_id.learn(docs.where(language_id.learnable()))
    held_out = F.coalesce(~language_id.learnable(), F.lit(False))
    return language_id.predict(docs.select("doc_id", "text", held_out.alias("held_out")), known).drop("text")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    return warc.link(warc.read_archives(spark, path))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"), with_text=False).drop("text")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(read(spark, sf_dir, "documents"), shards=8)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op8_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = chat_tools.exchange_calls(read(spark, sf_dir, "conversations"))
    return chat_tools.format_chats(messages, chat_tools.reply_schema()).select(
        F.col("conv").alias("conv_id"), "turn", "role", "call_id", "linked", "repeated", "level", "n_errors",
        F.sha2(F.col("json").cast("binary"), 256).alias("json_sha256"),
    )


def new_index(spark: SparkSession) -> exact_dedup.DigestIndex:
    path = shared_dir(spark, "digest-index")
    return exact_dedup.DigestIndex.open(spark, f"digest_index_{uuid.uuid4().hex}", path)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read(spark, sf_dir, "documents"), new_index(spark), "all")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(read(spark, sf_dir, "documents"), words=4, percent=85)


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(read(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op11_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return multi_index.search(multi_index.build(vectors), vectors.where("vec_id % 50 = 0"), k=5)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(read(spark, sf_dir, "documents"), tampered, {"n_chars": F.col("n_chars") + 1})


OP1_SQL = """
WITH RECURSIVE cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
hashed AS (
  SELECT doc_id, lines,
    list_transform(lines, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT % 2147483647) AS h
  FROM cut),
rolled AS (
  SELECT doc_id, lines, list_transform(range(1, len(h) + 1), lambda i:
    ((CASE WHEN i > 2 THEN h[i - 2] ELSE 0 END * 82517 % 2147483647
      + CASE WHEN i > 1 THEN h[i - 1] ELSE 0 END) * 82517 + h[i]) % 2147483647) AS r
  FROM hashed),
ended AS (
  SELECT doc_id, lines, list_filter(range(1, len(r) + 1), lambda i:
    i = len(r) OR coalesce(i > 1 AND r[i] < r[i - 1] AND r[i] <= r[i + 1], FALSE)) AS ends
  FROM rolled),
numbered AS (
  SELECT doc_id, lines, ends, unnest(range(1, len(ends) + 1)) AS no FROM ended),
chunks AS (
  SELECT doc_id, no, CASE WHEN no = 1 THEN 1 ELSE ends[no - 1] + 1 END AS a, ends[no] AS b,
    array_to_string(lines[CASE WHEN no = 1 THEN 1 ELSE ends[no - 1] + 1 END : ends[no]], chr(10)) AS body
  FROM numbered),
marked AS (
  SELECT *, b > a AND row_number() OVER (PARTITION BY body, b > a ORDER BY doc_id, no) > 1 AS gone FROM chunks)
SELECT doc_id, sum(b - a + 1)::BIGINT AS n_lines, count(*) AS n_chunks,
  count(*) FILTER (gone) AS n_removed_chunks,
  coalesce(sum(b - a + 1) FILTER (gone), 0)::BIGINT AS n_removed_lines,
  sha256(coalesce(string_agg(body, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP2_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
starts AS (
  SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0),
phrases AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i : i + 9], ' ') AS phrase FROM starts),
sizes AS (SELECT DISTINCT n FROM phrases),
docs AS (
  SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n),
hits AS (
  SELECT doc_id, i, d.n, item_id FROM docs d JOIN phrases p
    ON p.n = d.n AND p.phrase = array_to_string(ws[i : i + d.n - 1], ' ')),
words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4_SQL = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes
  FROM pages),
m AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS stays
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN stays = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN stays <> page_id THEN stays END AS refers_to, TRUE AS intact
FROM m
"""

OP9_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# A step of a path: the side its sibling stands on and the sibling, nothing where there is none.
OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql()} AS leaf, {_leaf_sql("n_chars + 1")} AS changed,
    list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda crc, byte: CASE WHEN xor(crc, byte) & 1 = 1 THEN xor(xor(crc, byte) >> 1, 3988292384::BIGINT)
        ELSE xor(crc, byte) >> 1 END) AS crc
  FROM documents),
leaves AS (
  SELECT row_number() OVER () AS k, doc_id, tree, leaf,
    CASE WHEN xor(crc, 4294967295::BIGINT) % 7 = 0 THEN changed ELSE leaf END AS shown,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY tree) AS n
  FROM d),
nodes AS (
  SELECT tree, 0 AS lvl, i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY tree, lvl, i // 2, n),
subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, i, h, n FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
  FROM tops WHERE n > 1 GROUP BY lvl, i // 2, n),
levels AS (SELECT DISTINCT tree, lvl FROM nodes WHERE n > 1),
top_levels AS (SELECT DISTINCT lvl FROM tops WHERE n > 1),
steps AS (
  SELECT k, l.lvl, CASE WHEN (d.i >> l.lvl) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '') AS step
  FROM leaves d JOIN levels l ON l.tree = d.tree
  LEFT JOIN nodes s ON s.tree = d.tree AND s.lvl = l.lvl AND s.i = xor(d.i >> l.lvl, 1)
  UNION ALL
  SELECT k, 1000 + l.lvl, CASE WHEN (r.i >> l.lvl) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '')
  FROM leaves d JOIN subroots r ON r.tree = d.tree CROSS JOIN top_levels l
  LEFT JOIN tops s ON s.lvl = l.lvl AND s.i = xor(r.i >> l.lvl, 1)),
paths AS (SELECT k, list(step ORDER BY lvl) AS path, string_agg(substr(step, 2), '' ORDER BY lvl) AS siblings FROM steps GROUP BY k),
back AS (
  SELECT d.*, siblings, list_reduce(list_prepend(shown, coalesce(path, []::VARCHAR[])),
    lambda h, s: sha256(CASE WHEN s[1] = 'L' THEN substr(s, 2) || h ELSE h || substr(s, 2) END)) AS folded_root
  FROM leaves d LEFT JOIN paths USING (k))
SELECT doc_id, leaf, r.h AS subroot, t.h AS root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
  folded_root = t.h AS verified
FROM back JOIN subroots r USING (tree) CROSS JOIN (SELECT h FROM tops WHERE n = 1) t
"""

QUERIES = {
    "op1_line_dedup": Query(op1_line_dedup, OP1_SQL),
    "op2_decontamination": Query(op2_decontamination, OP2_SQL),
    "op3_language_id": Query(op3_language_id),
    "op4_warc": Query(op4_warc, OP4_SQL),
    "op5_suffix_dedup": Query(op5_suffix_dedup),
    "op6_sharding": Query(op6_sharding),
    "op7_jaccard_join": Query(op7_jaccard_join),
    "op8_chat_tools": Query(op8_chat_tools),
    "op9_exact_dedup": Query(op9_exact_dedup, OP9_SQL),
    "op10_byte_bpe": Query(op10_byte_bpe),
    "op11_multi_index": Query(op11_multi_index),
    "op12_alignment": Query(op12_alignment),
    "op13_merkle": Query(op13_merkle, OP13_SQL),
    "pipeline": Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
