"""Line dedup over content-defined chunks of lines.

A polynomial hash rolls over the hashes of three lines. A chunk ends after a
line whose rolling hash is lower than the one before and not above the next,
so boundaries depend on nearby lines only: lines put in or left out move no
boundary further down. With `fine` the rule looks at one line instead of three,
runs of equal lines count as one line there, and a run of four or more is cut
into pairs (the last takes three if the run is odd), so short passages and long
runs of one line have boundaries of their own. Chunks of two or more lines that occur again anywhere
are compared byte by byte; the first occurrence (smallest id, then chunk
number) stays and the others are removed.

Texts are shuffled once, into a table bucketed by row; both later joins read it
bucket by bucket without an exchange. Only hashes are shuffled to find repeated
chunks, counted before the shuffle. The bytes of a chunk move only if its hash
occurs twice, and then once per task and body; they are compared there, and
where one hash has several bodies, the bodies decide instead of the hash.

Defined cases: a null text counts as empty and has one empty line; single-line
chunks always stay; a document without id keeps its lines (and counts as the
first occurrence); rows that repeat an id and a text are treated alike, and of
rows that share an id only each loses its own chunks. Rows alike in id and text
are dealt over several buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import pinned, saved, shuffle_width
from rillmark.session import shared_dir

PRIME = 2_147_483_647
BASE = 82_517
LEAST_LINES = 2
#: With `fine`: a run of so many equal lines is cut inside.
LEAST_RUN = 4
#: Buckets that rows alike in id and text are dealt over.
SPREAD = 64


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def row_key(doc: Column, text: Column) -> Column:
    """A digest of id and text; the id's length in front keeps the two apart."""
    name = doc.cast("string")
    head = F.coalesce(F.concat(F.length(name).cast("string"), F.lit(":"), name), F.lit("-"))
    return F.unhex(F.sha2(F.concat(head, F.coalesce(text, F.lit(""))).cast("binary"), 256))


def chunk_key(body: Column) -> Column:
    return F.xxhash64(body)


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long") % PRIME


def fine_ends(hashed: DataFrame) -> DataFrame:
    """Adds ends: runs of equal lines lower than both neighbours end a chunk, long runs are cut into pairs."""
    last = F.size("lines") - 1
    numbers = F.sequence(F.lit(0), last)
    runs = pinned(hashed, "runs", F.filter(numbers, lambda i: (i == 0) | (F.get("h", i) != F.get("h", i - 1))))
    runs = pinned(runs, "v", F.transform("runs", lambda s: F.get("h", s)))
    end = lambda k: F.coalesce(F.get("runs", k + 1) - 1, last)
    low = lambda k: (F.get("v", k) < F.get("v", k - 1)) & (F.get("v", k) <= F.get("v", k + 1))

    def own(s: Column, k: Column) -> Column:
        pairs = F.concat(F.array(s - 1), F.sequence(s + 1, end(k) - 2, F.lit(2)), F.array(end(k)))
        bound = F.when((end(k) == last) | low(k), F.array(end(k))).otherwise(F.array().cast("array<int>"))
        return F.when(end(k) - s + 1 >= LEAST_RUN, pairs).otherwise(bound)

    ends = F.filter(F.array_sort(F.array_distinct(F.flatten(F.transform("runs", own)))), lambda i: i >= 0)
    return pinned(runs, "ends", ends)


def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fine: bool = False) -> DataFrame:
    """doc, row (key of id and text), lines, ends: the last line (from 0) of each chunk."""
    id_, text = F.col(id_col), F.col(text_col)
    named = docs.select(id_.alias("doc"), row_key(id_, text).alias("row"), text.alias("body"))
    cut = pinned(named, "lines", lines_of(F.col("body")))
    hashed = pinned(cut, "h", F.transform("lines", line_hash))
    if fine:
        return fine_ends(hashed).select("doc", "row", "lines", "ends")
    before = lambda i, k: F.coalesce(F.get("h", i - k), F.lit(0))
    rolled = pinned(
        hashed, "r", F.transform("h", lambda h, i: ((before(i, 2) * BASE % PRIME + before(i, 1)) * BASE + h) % PRIME)
    )
    last = F.size("lines") - 1
    low = lambda i: (F.get("r", i) < F.get("r", i - 1)) & (F.get("r", i) <= F.get("r", i + 1))
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | low(i))
    return pinned(rolled, "ends", ends).select("doc", "row", "lines", "ends")


def first_line(k: Column) -> Column:
    """The first line (from 0) of chunk k."""
    return F.when(k == 0, 0).otherwise(F.get("ends", k - 1) + 1)


def chunk_body(k: Column) -> Column:
    return F.array_join(F.slice("lines", first_line(k) + 1, F.get("ends", k) - first_line(k) + 1), "\n")


def cut_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fine: bool = False) -> DataFrame:
    """doc, row, part, text, ends, keys (null for a single line): a table bucketed by row and part."""
    spark = docs.sparkSession
    several = lambda k: F.get("ends", k) - first_line(k) + 1 >= LEAST_LINES
    keys = F.transform("ends", lambda _, k: F.when(several(k), chunk_key(chunk_body(k))))
    cut = chunked(docs, id_col, text_col, fine).select(
        "doc", "row", (F.spark_partition_id() % SPREAD).alias("part"),
        F.array_join("lines", "\n").alias("text"), "ends", keys.alias("keys"),
    )
    table, buckets = f"cut_lines_{uuid.uuid4().hex}", shuffle_width(spark)
    (
        cut.repartition(buckets, "row", "part")
        .write.format("parquet").option("compression", "zstd")
        .bucketBy(buckets, "row", "part")
        .option("path", shared_dir(spark, "cut-lines")).saveAsTable(table)
    )
    return spark.table(table)


def later(chunks: DataFrame, same: list[str]) -> DataFrame:
    """row, part, no: chunks that are not the first of those alike in `same`; without an id none is."""
    place = F.struct("doc", "no", "row")
    # Written first: both sides of the join are then plain shuffles, which AQE splits at a hot chunk.
    firsts = saved(chunks.groupBy(*same).agg(F.min(place).alias("first")), "first-chunks")
    return (
        chunks.join(firsts, same)
        .where(~place.eqNullSafe(F.col("first")) & F.col("doc").isNotNull())
        .select("row", "part", "no")
    )


def repeated(cut: DataFrame) -> DataFrame:
    """row, part, no: chunks equal, byte by byte, to one that comes before them."""
    chunks = cut.select("doc", "row", "part", F.posexplode("keys").alias("no", "key")).where("key IS NOT NULL")
    twice = saved(
        chunks.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("key"), "repeated-hashes"
    )
    again = saved(chunks.join(twice, "key", "left_semi"), "repeated-chunks")
    # Numbers of a row's chunks go to its text, not the text to them.
    wanted = again.groupBy("row", "part").agg(F.collect_set(F.struct("no", "key")).alias("wanted"))
    met = cut.select("doc", "row", "part", "text", "ends").join(wanted, ["row", "part"])
    lines = pinned(met, "lines", lines_of(F.col("text")))
    each = F.transform("wanted", lambda w: F.struct(w["no"].alias("no"), w["key"].alias("key"), chunk_body(w["no"]).alias("body")))
    bodies = lines.select("doc", "row", "part", F.explode(each).alias("c")).select("doc", "row", "part", "c.*")
    different = bodies.groupBy("key", "body").agg(F.count(F.lit(1)).alias("times"))
    clashing = saved(
        different.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "clashing-hashes"
    )
    if clashing.isEmpty():
        return later(again, ["key"])
    by_bytes = saved(bodies.join(clashing, "key", "left_semi"), "clashing-chunks")
    return later(again.join(clashing, "key", "left_anti"), ["key"]).unionByName(later(by_bytes, ["key", "body"]))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fine: bool = False) -> DataFrame:
    """One row per document: id, kept text, n_lines, n_chunks, n_removed_chunks, n_removed_lines."""
    cut = cut_table(docs, id_col, text_col, fine)
    gone = saved(repeated(cut).groupBy("row", "part").agg(F.collect_set("no").alias("gone")), "removed-chunks")
    whole = cut.select("doc", "row", "part", "text", "ends").join(gone, ["row", "part"], "left")
    whole = pinned(whole.withColumn("gone", F.coalesce("gone", F.array().cast("array<int>"))), "lines", lines_of(F.col("text")))
    gone_list = F.col("gone")
    numbers = F.sequence(F.lit(0), F.size("ends") - 1)
    kept = F.filter(numbers, lambda k: ~F.array_contains(gone_list, k))
    parts = F.transform(kept, lambda k: F.slice("lines", first_line(k) + 1, F.get("ends", k) - first_line(k) + 1))
    left = pinned(whole.select("doc", "lines", "ends", "gone"), "left", F.flatten(parts))
    return left.select(
        F.col("doc").alias(id_col),
        F.array_join("left", "\n").alias(text_col),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("ends").cast("long").alias("n_chunks"),
        F.size("gone").cast("long").alias("n_removed_chunks"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_removed_lines"),
    )
