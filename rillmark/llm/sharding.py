"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring; a key belongs to the next point
clockwise. Shards have capacities, and keys that reach a full shard go on
clockwise to the next point whose shard has room. Keys of an arc are taken in
the order of a second hash, so who overflows is the same in every run.

No task sees a whole shard: arcs are cut into buckets of about `bucket_rows`
rows by the second hash, ranks run inside a bucket, and counts of the buckets
before it are added. Only the counts of the arcs (shards x points, a parameter)
come to the driver, where the overflow is walked round the ring.

Defined cases: a null id is a key like any other; a null text has size 1 and the
checksum of the empty text; rows alike in id, size and checksum are told apart
only by their slot; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rillmark.llm.common import saved

RING_BITS = 63
CELL_BITS = 13


def ring(shards: int, points: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise."""
    place = lambda s, p: int.from_bytes(hashlib.sha256(f"{s}/{p}".encode()).digest()[:8], "big") >> 1
    return sorted((place(s, p), s) for s in range(shards) for p in range(points))


def even_capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows each shard may hold. Without slack they add up to the total, at most one apart."""
    if slack:
        return [-int(-(1 + slack) * total // shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def walk(nodes: list[tuple[int, int]], counts: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot): each arc's keys where they find room."""
    filled, parts = [0] * len(room), []
    for arc in range(len(nodes)):
        at, done, n = arc, 0, counts.get(arc, 0)
        while done < n:
            shard = nodes[at % len(nodes)][1]
            if take := min(n - done, room[shard] - filled[shard]):
                parts.append((arc, done, done + take, shard, filled[shard]))
                filled[shard] += take
                done += take
            at += 1
    return parts


def cells(nodes: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(cell, low, high, arc): the ring in equal cells, each cut where nodes stand."""
    width, places = 1 << (RING_BITS - CELL_BITS), [p for p, _ in nodes]
    out = []
    for cell in range(1 << CELL_BITS):
        low, end = cell * width, (cell + 1) * width - 1
        while low <= end:
            k = bisect_left(places, low)
            high = min(end, places[k]) if k < len(places) else end
            out.append((cell, low, high, k % len(nodes)))
            low = high + 1
    return out


def assign(
    docs: DataFrame, shards: int = 8, points: int = 128, slack: float = 0.0,
    id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 50_000,
) -> DataFrame:
    """One row per document: id, size, text_crc32, shard, slot (gapless from 0 in its shard).

    With `slack` 0 the row counts of shards are at most one apart; a positive
    slack lets a shard hold up to (1 + slack) times the mean and moves less.
    """
    spark = docs.sparkSession
    nodes = ring(shards, points)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keys = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("crc"),
    ).select(
        "*",
        F.shiftrightunsigned(F.xxhash64("id"), 1).alias("place"),
        F.shiftrightunsigned(F.xxhash64("id", "size", "crc", F.lit(2)), 1).alias("turn"),
    )
    # At most 2^CELL_BITS + shards x points rows, whatever the data.
    cuts = F.broadcast(spark.createDataFrame(cells(nodes), "cell INT, low LONG, high LONG, arc INT"))
    at = F.shiftright("place", RING_BITS - CELL_BITS).cast("int")
    rows = keys.join(cuts, (at == F.col("cell")) & F.col("place").between(F.col("low"), F.col("high")))
    rows = saved(rows.select("id", "size", "crc", "arc", "turn"), "ring-keys")
    total = rows.count()
    bits = max(0, (max(1, total // (len(nodes) * bucket_rows))).bit_length())
    rows = rows.withColumn("bucket", F.shiftright("turn", RING_BITS - bits) if bits else F.lit(0).cast("long"))
    counts = saved(rows.groupBy("arc", "bucket").agg(F.count(F.lit(1)).alias("n")), "ring-counts")
    arcs = {r.arc: r.n for r in counts.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    plan = walk(nodes, arcs, even_capacities(total, shards, slack))
    # At most one part per arc and one more per shard that fills up.
    parts = F.broadcast(spark.createDataFrame(plan, "arc INT, first LONG, end LONG, shard INT, base LONG"))
    before = F.sum("n").over(Window.partitionBy("arc").orderBy("bucket")) - F.col("n")
    offsets = counts.select("arc", "bucket", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("arc", "bucket").orderBy("turn", "id", "size", "crc"))
    ranked = (
        rows.withColumn("inside", inside).join(offsets, ["arc", "bucket"])
        .withColumn("rank", F.col("before") + F.col("inside") - 1)
    )
    return ranked.join(parts, "arc").where("rank >= first AND rank < end").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("base") + F.col("rank") - F.col("first")).alias("slot"),
    )
