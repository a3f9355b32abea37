"""N-gram Jaccard self join by count vectors, linked into classes.

Every text becomes the set of its distinct shingles (64-bit hashes). Hashes are
cut into groups, and two steps use the groups:

* Finding blocks. Two sets that reach the threshold differ in at most D
  shingles, D known from their size band. With more than D groups at least one
  group holds the same shingles in both, so the sum of each group's mixed
  hashes is a key under which every linked pair meets. No key is a single
  frequent shingle unless a whole group is. Some groups are empty; `slack` more
  groups than D + 1 make up for those, and a set with more empty groups than
  that also sends the smallest hashes of its prefix, which finds the pairs that
  only empty groups have in common.
* Comparing within a block. The numbers of shingles in 64 groups are a point;
  the sum of the smaller coordinates of two points bounds the overlap from
  above. Points are packed into an R-tree, whose boxes carry the largest
  coordinates and smallest sizes, and pairs of boxes that cannot reach the
  threshold are left out. What the tree leaves open is held against the numbers
  in finer groups, as many more as the sets are larger: in 64 groups sets of a
  thousand shingles look alike whatever they hold. Two texts that share many
  keys meet in many blocks; a block leaves a pair to an earlier one that it can
  tell both are in. Blocks of up to PAIRED members, which are most, give their
  pairs without any point: the same two texts meet in dozens of them. What
  survives is first held against a part of both sets (SLICE of the 64 groups),
  whose overlap with the other coordinates is a closer bound, and only what
  is left is verified on the whole sets.

An R-tree over all points by itself gives right results too, but random texts
lie closer in 64 dimensions than boxes can tell apart, so it compares nearly all
texts of a similar size; hence the blocks first.

Copies (equal sets) are one class from the start. All others are first compared
with the best hub of their blocks; only members of a block that are still in
different components go through the R-tree, in leaves of bounded size: first the
best pair of each component in a leaf, then all pairs of components still apart.
So a group of thousands of near copies costs links in proportion to its size, and
no block is gathered in one task.

Tables between the steps are deleted as soon as what was made of them is written.

Defined cases: null and wordless texts have no shingles and link with nothing;
a row without id is returned with no component; rows that repeat an id count as
one document that has the links of each. Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm import bytes_np as B
from rillmark.llm.bytes_np import U64, mix
from rillmark.llm.common import dropped, saved, shuffle_width, small_batches
from rillmark.llm.components import components

GAP = np.zeros(256, dtype=bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MOST_KEYS = 400_000  # kept by a task before it passes them on
DIMENSIONS = 64
LEAF, FANOUT, SMALL = 256, 16, 4096
PAIRED = 8  # members of a block whose pairs are listed
AT_ONCE = 1 << 21  # coordinates compared together
SLICE = 16  # groups of a point whose shingles are compared before whole sets are
BEFORE = 8  # earlier blocks of a member that a block knows of
NODE = "kind int, id long, n long, d1 long, d2 long, key long"
NODE_ARROW = pa.schema([("kind", pa.int32()), *((c, pa.int64()) for c in ("id", "n", "d1", "d2", "key"))])
# Sets of this many ids are looked up by a broadcast; beyond it by a shuffle.
BROADCAST_IDS = 1_000_000


def _saved_small(df: DataFrame, purpose: str) -> DataFrame:
    """`saved` of rows made in Python from texts, sets or points, which go there in small batches."""
    with small_batches(df.sparkSession):
        return saved(df, purpose)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than k words are one shingle."""
    data, offsets = B.column_bytes(column)
    words, text = B.word_hashes(data, offsets, GAP, LOWER)
    at = np.searchsorted(text, np.arange(len(column) + 1))
    by = B.odd(k, 11)
    n = len(words) - k + 1
    joined = np.zeros(max(n, 0), dtype=U64)
    for j in range(k if n > 0 else 0):
        joined += words[j : j + n] * by[j]
    joined = mix(joined)
    sets = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= k:
            sets.append(np.unique(joined[a : b - k + 1]))
        elif b > a:
            whole = (words[a:b] * by[: b - a]).sum(dtype=U64) + U64(b - a)
            sets.append(mix(np.array([whole], dtype=U64)))
        else:
            sets.append(np.zeros(0, dtype=U64))
    return sets


@lru_cache(maxsize=256)
def band(i: int, percent: int) -> tuple[int, int, int, int, int]:
    """(least size, end of sizes, largest partner, groups, slack) of size band i of the smaller set of a pair."""
    low = 1
    for _ in range(i):
        low = max(low + 1, low * 8 // 5)
    end = max(low + 1, low * 8 // 5)
    partner = 100 * (end - 1) // percent
    most = (100 - percent) * (end - 1 + partner) // (100 + percent)
    slack = 1 + most // 32
    return low, end, partner, most + 1 + slack, slack


def bands_of(n: int, percent: int) -> Iterator[int]:
    """The bands where a set of n shingles may be the smaller or the larger of a pair."""
    i = 0
    while (b := band(i, percent))[0] <= n:
        if n <= b[2]:
            yield i
        i += 1


@lru_cache(maxsize=64)
def group_ends(groups: int) -> np.ndarray:
    """Hashes below which groups 0, 1, .. end; the last has no end."""
    return np.array([(g << 64) // groups for g in range(1, groups)], dtype=U64)


def block_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """The keys under which a set (sorted hashes) meets every set it may be linked with."""
    n, keys = len(hashes), []
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(mix(hashes + B.STEP), out=total[1:])
    for i in bands_of(n, percent) if n else ():
        _, _, _, groups, slack = band(i, percent)
        at = np.concatenate([[0], np.searchsorted(hashes, group_ends(groups)), [n]])
        full = np.flatnonzero(np.diff(at))
        signature = total[at[full + 1]] - total[at[full]]
        here = mix(np.array([i + 1], dtype=U64))
        keys.append(mix(signature + full.astype(U64) * B.MIX_A + here))
        if groups - len(full) > slack:
            prefix = hashes[: n - -(-percent * n // 100) + 1]
            keys.append(mix(prefix * B.MIX_B + here))
    return np.concatenate(keys) if keys else np.zeros(0, dtype=U64)


def _emit(k: int, percent: int, width: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, held = [], [], 0
        seen: set[tuple[int, int, int]] = set()  # copies within the task send their keys once

        def flush() -> Iterator[pa.RecordBatch]:
            if keys:
                key = np.concatenate(keys)
                doc = np.repeat(np.array(docs, dtype=np.int64), [len(x) for x in keys])
                yield from B.deal(key, doc, np.zeros(len(key), dtype=np.int32), width)
                keys.clear()
                docs.clear()
                seen.clear()

        for part in B.slices(batches, 1):
            ids = part.column(0).to_pylist()
            sets = shingle_sets(part.column(1), k)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            d1 = np.array([s.sum(dtype=U64) for s in sets], dtype=U64).view(np.int64)
            d2 = np.array([mix(s ^ B.MIX_A).sum(dtype=U64) for s in sets], dtype=U64).view(np.int64)
            known = np.array([i is not None for i in ids])
            number = np.array([i if i is not None else 0 for i in ids], dtype=np.int64)
            yield from B.packed(B.STATS, mix(number[known].astype(U64)) % U64(width), [number[known], n[known], d1[known], d2[known]])
            for i in np.flatnonzero(known & (n > 0)):
                if (copy := (int(n[i]), int(d1[i]), int(d2[i]))) not in seen:
                    seen.add(copy)
                    keys.append(block_keys(sets[i], percent))
                    docs.append(number[i])
                    held += len(keys[-1])
                if held > MOST_KEYS:
                    yield from flush()
                    held = 0
        yield from flush()

    return over


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unpacks rows, sorted by `p`: the statistics of every document, and (key, id) of keys that several documents have."""
    none = lambda n: pa.nulls(n, pa.int64())
    kinds = lambda kind, n: pa.array(np.full(n, kind, dtype=np.int32))

    def pairs(keys: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        n = len(keys)
        columns = [kinds(B.KNOWN, n), pa.array(docs), none(n), none(n), none(n), pa.array(keys.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, schema=NODE_ARROW)

    for rows in B.parts_in_turn(batches):
        open_rows = []
        for r in rows:
            if r["kind"] == B.OPEN:
                open_rows.append((r["a"], r["b"], r["c"], r["d"]))
            elif r["kind"] == B.KNOWN:
                yield pairs(B.from_key_planes(r["a"]), B.from_planes(r["b"], np.int64))
            else:
                cols = [pa.array(np.frombuffer(r[c], dtype=np.int64)) for c in "abcd"]
                yield pa.RecordBatch.from_arrays([kinds(B.STATS, len(cols[0])), *cols, none(len(cols[0]))], schema=NODE_ARROW)
        keys, docs, _ = B.settle(open_rows)
        yield pairs(keys, docs)


def groups_of(n: int) -> int:
    """Groups, a power of 2, in which a set of n shingles is counted: one for 2 shingles, from 1,024 on for up to 8."""
    up = lambda x: 1 << max(0, x - 1).bit_length()
    return max(DIMENSIONS, min(8 * DIMENSIONS, up(-(-n // 2))), up(-(-n // 8)))


def _point(hashes: np.ndarray) -> bytes:
    """How many hashes fall into each group, up to 15 in half a byte, and in 8 bytes how many are beyond that."""
    groups = groups_of(len(hashes))
    counts = np.bincount((hashes & U64(groups - 1)).astype(np.int64), minlength=groups)
    low = np.minimum(counts, 15).astype(np.uint8)
    return (low[::2] | low[1::2] << 4).tobytes() + (counts - low).sum(keepdims=True, dtype=np.int64).tobytes()


class Points:
    """Points of several sets, in groups of their own numbers; coarser groups are sums of finer ones.

    The smaller numbers of two sets, summed over groups, and the smaller number
    beyond 15 bound the overlap of the sets.
    """

    def __init__(self, packed: list[bytes]):
        self.groups = np.array([2 * (len(x) - 8) for x in packed], dtype=np.int64)
        self.beyond = np.array([int.from_bytes(x[-8:], "little") for x in packed], dtype=np.int64)
        self.place, self.low = np.zeros(len(packed), dtype=np.int64), {}
        for groups in np.unique(self.groups).tolist():
            here = np.flatnonzero(self.groups == groups)
            both = np.frombuffer(b"".join(packed[x][:-8] for x in here), dtype=np.uint8).reshape(len(here), -1)
            self.low[groups] = np.stack([both & 15, both >> 4], axis=2).reshape(len(here), groups)
            self.place[here] = np.arange(len(here))

    def at(self, rows: np.ndarray, groups: int) -> np.ndarray:
        """The points of rows in as many groups, which are no more than any of them has."""
        out = np.zeros((len(rows), groups), dtype=np.int32)
        for own, low in self.low.items():
            here = self.groups[rows] == own
            if own == groups:
                out[here] = low[self.place[rows[here]]]
            elif here.any():
                out[here] = low[self.place[rows[here]]].reshape(-1, own // groups, groups).sum(axis=1, dtype=np.int32)
        return out

    def coarse(self) -> np.ndarray:
        """DIMENSIONS coordinates, and what is beyond as one more."""
        return np.column_stack([self.at(np.arange(len(self.groups)), DIMENSIONS), self.beyond.astype(np.int32)])


def bounds(p: Points, i: np.ndarray, q: Points, j: np.ndarray, skip: int = 0) -> np.ndarray:
    """For each k the most that p[i[k]] and q[j[k]] can have in common in all but the first `skip` of DIMENSIONS groups."""
    out = np.minimum(p.beyond[i], q.beyond[j])
    groups = np.minimum(p.groups[i], q.groups[j])
    for g in np.unique(groups).tolist():
        here = np.flatnonzero(groups == g)
        for k in range(0, len(here), step := max(1, AT_ONCE // g)):
            at = here[k : k + step]
            least = np.minimum(p.at(i[at], g), q.at(j[at], g)).reshape(len(at), -1, DIMENSIONS)
            out[at] += least[:, :, skip:].sum(axis=(1, 2))
    return out


def _slice(hashes: np.ndarray) -> np.ndarray:
    """Half of each hash that falls into the first SLICE groups, in order."""
    return (hashes[(hashes & U64(DIMENSIONS - 1)) < U64(SLICE)] >> U64(32)).astype(np.uint32)


def wanted_rows(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, body of the wanted ids, a written table."""
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body")).join(wanted, "id", "left_semi")


def sets_of(rows: DataFrame, k: int) -> DataFrame:
    """id, hashes (sorted, packed) of rows (id, body)."""
    schema = pa.schema([("id", pa.int64()), ("hashes", pa.binary())])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in B.slices(batches, 1):
            sets = shingle_sets(part.column(1), k)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    return _saved_small(rows.mapInArrow(B.tidy(over), "id long, hashes binary"), "sets")


def outlines_of(rows: DataFrame, k: int) -> DataFrame:
    """id, slice (packed), point (packed), n of rows (id, body): what bounds an overlap."""
    schema = pa.schema([("id", pa.int64()), ("slice", pa.binary()), ("point", pa.binary()), ("n", pa.int64())])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in B.slices(batches, 1):
            sets = shingle_sets(part.column(1), k)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([_slice(s).tobytes() for s in sets], pa.binary()),
                    pa.array([_point(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                ],
                schema=schema,
            )

    return _saved_small(rows.mapInArrow(B.tidy(over), "id long, slice binary, point binary, n long"), "outlines")


def reaches(shared, a, b, percent: int):
    """Whether |A and B| is enough: 100 x shared >= percent x (a + b - shared)."""
    return 100 * shared >= percent * (a + b - shared)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two sorted arrays have in common; values that an array repeats may count more often."""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _beside(pairs: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """a, b and for each column `c` of rows (by id) `c` of a and `c_b` of b; `pairs` is a written table.

    Where the pairs are few enough to be sent to all tasks, only rows that stand
    in a pair move, and the first of a pair moves once.
    """
    few = pairs.count() <= BROADCAST_IDS
    near = F.broadcast(pairs) if few else pairs
    one = rows.select(F.col("id").alias("a"), *columns)
    two = rows.select(F.col("id").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    if few:
        two = two.join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi")
    return one.join(near, "a").join(two, "b")


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def bounded(pairs: DataFrame, outlines: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose points, and then slices, leave it open whether they reach the threshold.

    With slices the overlap is at most that of the slices, whose half hashes can
    only make it larger, and the smaller coordinates of all other groups.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = (Points(batch.column(c).to_pylist()) for c in ("point", "point_b"))
            na, nb = (batch.column(c).to_numpy() for c in ("n", "n_b"))
            each, sliced = np.arange(batch.num_rows), "slice" in batch.schema.names
            most = bounds(p, each, q, each, SLICE if sliced else 0)
            if sliced:
                halves = ([np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in batch.column(c)] for c in ("slice", "slice_b"))
                most += np.array([_common(x, y) for x, y in zip(*halves, strict=True)], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=PAIR).filter(pa.array(reaches(most, na, nb, percent)))

    alike = 100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")

    def left(of: DataFrame, columns: list[str], purpose: str) -> DataFrame:
        met = _beside(of, outlines, columns).where(alike).select("a", "b", *[x for c in columns for x in (c, f"{c}_b")])
        return _saved_small(met.mapInArrow(B.tidy(over), "a long, b long").distinct(), purpose)

    near = left(pairs, ["point", "n"], "near-points")
    out = left(near, ["slice", "point", "n"], "bounded-pairs")
    dropped(near)
    return out


def verified(pairs: DataFrame, docs: DataFrame, outlines: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold; `pairs` is a written table."""
    left = bounded(pairs, outlines, percent)
    ids = saved(left.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted-ids")
    sets = sets_of(wanted_rows(docs, ids, id_col, text_col), k)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("hashes"), batch.column("hashes_b"), strict=True):
                x, y = np.frombuffer(one.as_buffer(), dtype=U64), np.frombuffer(two.as_buffer(), dtype=U64)
                keep.append(reaches(_common(x, y), len(x), len(y), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=PAIR).filter(pa.array(keep, pa.bool_()))

    met = _beside(left, sets, ["hashes"]).select("a", "b", "hashes", "hashes_b")
    out = _saved_small(met.mapInArrow(B.tidy(over), "a long, b long"), "links")
    dropped(left, ids, sets)
    return out


def hub_pairs(placed: DataFrame) -> DataFrame:
    """a, b: every member outside the part of a block's hub, with the best such hub of its blocks.

    `placed` has key, id, part and share (of an id's keys that others have too).
    The hub of a block is its member of the largest share: the original among its
    near copies. All that are linked to it meet it in a block, so one pair for
    each member is enough to hang a group of any size on its centre.
    """
    rank = F.struct("share", (-F.col("id")).alias("back"), "part")
    tops = placed.groupBy("key").agg(F.max(rank).alias("top"), F.min("part").alias("low"), F.max("part").alias("high"))
    tops = saved(tops.where("low <> high").select("key", "top"), "hubs")
    met = placed.join(tops, "key").where(F.col("part") != F.col("top.part"))
    best = met.groupBy("id").agg(F.max(F.struct("top.share", "top.back")).alias("best"))
    hub = -F.col("best.back")
    out = saved(best.select(F.col("id").alias("a"), hub.alias("b")), "hub-pairs")
    dropped(tops)
    return out


def listed_pairs(blocks: DataFrame) -> DataFrame:
    """a < b: the pairs of all blocks, each once."""
    one = blocks.groupBy("key").agg(F.collect_list("id").alias("ids")).select("ids", F.explode("ids").alias("a"))
    return saved(one.select("a", F.explode("ids").alias("b")).where("a < b").distinct(), "listed-pairs")


def still_apart(pairs: DataFrame, linked: DataFrame) -> DataFrame:
    """The pairs (a, b) in different components."""
    one, two = (linked.select(F.col("id").alias(c), F.col("component").alias(f"{c}_in")) for c in "ab")
    met = pairs.join(one, "a", "left").join(two, "b", "left")
    return met.where(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select("a", "b")


def in_parts(blocks: DataFrame, linked: DataFrame) -> DataFrame:
    return blocks.join(linked, "id", "left").select("key", "id", "share", F.coalesce("component", "id").alias("part"))


def boxes(points: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Levels of an R-tree over points sorted by size and then by their largest group.

    Each level has (largest coordinates, smallest size, members) of its boxes;
    level 0 holds points, each further level boxes of the one below.
    """
    order = np.lexsort((points.argmax(axis=1), sizes))
    members = [order[i : i + FANOUT] for i in range(0, len(order), FANOUT)]
    levels = [(np.array([points[m].max(axis=0) for m in members]), np.array([sizes[m].min() for m in members]), members)]
    while len(levels[-1][2]) > 1:
        top, low, _ = levels[-1]
        members = [np.arange(i, min(i + FANOUT, len(low))) for i in range(0, len(low), FANOUT)]
        levels.append((np.array([top[m].max(axis=0) for m in members]), np.array([low[m].min() for m in members]), members))
    return levels


def tree_join(p: np.ndarray, np_: np.ndarray, q: np.ndarray, nq: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of points whose summed coordinate minima can reach the threshold.

    Descends the tree of p with every point of q. A box can be reached if the
    minima of its largest coordinates do, taking its smallest size: the overlap
    that a pair needs grows with both sizes.
    """
    if len(p) * len(q) <= SMALL:
        # One box holds all: its points are compared directly.
        bound = np.minimum(p[:, None, :], q[None, :, :]).sum(axis=2)
        return np.nonzero(reaches(bound, np_[:, None], nq[None, :], percent))
    levels = boxes(p, np_)
    found_p, found_q = [], []
    for j in range(len(q)):
        at = np.arange(len(levels[-1][2]))
        for top, low, members in reversed(levels):
            bound = np.minimum(top[at], q[j]).sum(axis=1)
            at = at[reaches(bound, low[at], nq[j], percent)]
            at = np.concatenate([members[x] for x in at]) if len(at) else at[:0]
        at = at[reaches(np.minimum(p[at], q[j]).sum(axis=1), np_[at], nq[j], percent)] if len(at) else at
        found_p.append(at)
        found_q.append(np.full(len(at), j))
    return (np.concatenate(found_p), np.concatenate(found_q)) if found_p else (np.zeros(0, int), np.zeros(0, int))


def open_pairs(
    blocks: DataFrame, linked: DataFrame, outlines: DataFrame, percent: int, best: bool
) -> tuple[DataFrame, list[DataFrame]]:
    """a, b: pairs of a block in different components that the R-tree and their points do not rule out.

    And the tables that are read for them, to be dropped once the pairs are written.

    With `best`, of the pairs that a task finds in a block only those with the
    highest bound of a component, which are enough to join components that are near.

    The largest component of a block needs no pairs inside itself: the other
    members (minor) meet each other and it. A block of up to LEAF members is one
    leaf. Of a larger one both sides are cut into leaves of about LEAF members,
    and a task joins one pair of leaves.

    All blocks are in one order, the largest first, and a member brings the
    BEFORE blocks that come next before this one in its own list: a pair that
    has one of them in common is that block's.
    """
    placed = saved(in_parts(blocks, linked), "placed")
    parts = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("m"))
    sums = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("m").alias("all"), F.max(F.struct("m", "part")).alias("top")
    )
    mixed = saved(
        sums.where("parts > 1").select(
            "key", "all", F.col("top.part").alias("major"),
            F.ceil(F.col("top.m") / LEAF).alias("major_leaves"), F.ceil((F.col("all") - F.col("top.m")) / LEAF).alias("minor_leaves"),
        ),
        "mixed-blocks",
    )
    # A pair in different components is in mixed blocks only, so those are the ones to look back at.
    earlier = Window.partitionBy("id").orderBy(F.col("all").desc(), "key").rowsBetween(-BEFORE, -1)
    rows = placed.join(mixed, "key").withColumn("before", F.collect_list("key").over(earlier))
    rows = rows.join(outlines.select("id", "point", "n"), "id")
    minor = F.col("part") != F.col("major")
    leaf = lambda n: F.pmod(F.xxhash64("id"), n)
    mine = F.when(minor, leaf(F.col("minor_leaves"))).otherwise(F.col("minor_leaves") + leaf(F.col("major_leaves")))
    rows = rows.withColumns({"minor": minor, "leaf": mine})
    cell = lambda i, j, first, second: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"), first.alias("first"), second.alias("second"))
    yes, no, here, start = F.lit(True), F.lit(False), F.col("leaf"), F.lit(0).cast("long")
    one = F.array(cell(start, start, F.col("minor"), yes))
    # As the first of a pair: minor leaves only. As the second: minor leaves from there on, and major ones.
    end = F.col("minor_leaves") + F.col("major_leaves") - 1
    first = F.when(F.col("minor"), F.transform(F.sequence(here, end), lambda x: cell(here, x, yes, x == here)))
    last = F.least(here, F.col("minor_leaves")) - 1
    second = F.when(last >= 0, F.transform(F.sequence(start, last), lambda x: cell(x, here, no, yes)))
    none = F.array().cast("array<struct<i:bigint,j:bigint,first:boolean,second:boolean>>")
    cells = F.when(F.col("all") <= LEAF, one).otherwise(F.concat(F.coalesce(first, none), F.coalesce(second, none)))
    dealt = rows.select("key", "id", "part", "before", "point", "n", F.explode(cells).alias("c"))
    together = dealt.select("key", "c.*", "id", "part", "before", "point", "n").repartition("key", "i", "j")
    out = together.sortWithinPartitions("key", "i", "j").mapInArrow(B.tidy(_join_leaves(percent, best)), "a long, b long").distinct()
    return out, [placed, mixed]


def _earlier(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of up to BEFORE keys as rows of a matrix, filled up with -1; keys are never negative."""
    lists = column.combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(lists), BEFORE), -1, dtype=np.int64)
    out[np.arange(BEFORE) < size[:, None]] = lists.flatten().to_numpy()
    return out


def _join_leaves(percent: int, best: bool):
    """Pairs of each run of rows with one (key, i, j); a run has two leaves at most."""

    def pairs(rows: pa.Table, last: bool) -> tuple[np.ndarray, pa.Table]:
        label = np.stack([rows.column(c).to_numpy() for c in ("key", "i", "j")])
        starts = np.flatnonzero(np.concatenate([[True], (label[:, 1:] != label[:, :-1]).any(axis=0)]))
        ends = [*starts[1:], rows.num_rows]
        done = len(starts) if last else len(starts) - 1
        ids, parts, n, first, second = (rows.column(c).to_numpy() for c in ("id", "part", "n", "first", "second"))
        fine = Points(rows.column("point").to_pylist())
        points = fine.coarse()
        before = _earlier(rows.column("before"))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for a, b in zip(starts[:done], ends[:done], strict=True):
            x, y = a + np.flatnonzero(first[a:b]), a + np.flatnonzero(second[a:b])
            if len(x) and len(y):
                i, j = tree_join(points[x], n[x], points[y], n[y], percent)
                i, j = x[i], y[j]
                # Two that are both first and second meet twice.
                apart = (parts[i] != parts[j]) & ~(second[i] & first[j] & (i > j))
                i, j = i[apart], j[apart]
                most = bounds(fine, i, fine, j)
                ok = reaches(most, n[i], n[j], percent)
                i, j, most = i[ok], j[ok], most[ok]
                if best and len(i) > 1:
                    # Of each component, be it the first or the second of a pair.
                    part, pair = np.concatenate([parts[i], parts[j]]), np.tile(np.arange(len(i)), 2)
                    order = np.lexsort((pair, -(most / (n[i] + n[j] - most))[pair], part))
                    fresh = np.concatenate([[True], part[order][1:] != part[order][:-1]])
                    top = np.unique(pair[order][fresh])
                    i, j = i[top], j[top]
                met = np.zeros(len(i), dtype=bool)
                for back in range(BEFORE):
                    key = before[i, back]
                    met |= (key >= 0) & (before[j] == key[:, None]).any(axis=1)
                found.append((ids[i[~met]], ids[j[~met]]))
        one, two = (np.concatenate(c) for c in zip(*found, strict=True))
        return np.stack([np.minimum(one, two), np.maximum(one, two)]), rows.slice(starts[done] if done < len(starts) else rows.num_rows)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def batch_of(found: np.ndarray) -> pa.RecordBatch:
            found = np.unique(found, axis=1)
            return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], schema=PAIR)

        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch])
                out, rest = pairs(rows if rest is None else pa.concat_tables([rest, rows]), last=False)
                yield batch_of(out)
        if rest is not None and rest.num_rows:
            yield batch_of(pairs(rest, last=True)[0])

    return over


def joined(linked: DataFrame, more: DataFrame) -> DataFrame:
    """Components (id, component) after further links: those are between components, a small graph of its own."""
    if more.isEmpty():
        return linked
    one, two = (linked.select(F.col("id").alias(c), F.col("component").alias(f"{c}_in")) for c in "ab")
    between = more.join(one, "a", "left").join(two, "b", "left").select(
        F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b")
    )
    upper = saved(components(saved(between.where("a <> b").distinct(), "component-links")), "upper-components")
    top = upper.select(F.col("id").alias("component"), F.col("component").alias("top"))
    moved = linked.join(top, "component", "left").select("id", F.coalesce("top", "component").alias("component"))
    # Ids that had no link before stand in `upper` as their own components.
    new = upper.join(linked.select("id"), "id", "left_anti")
    return saved(moved.unionByName(new), "components")


def link(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable by links of `percent` or more)."""
    width = shuffle_width(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    packed = rows.mapInArrow(B.tidy(_emit(words, percent, width * B.SPREAD)), B.ROW_DDL)
    nodes = _saved_small(packed.repartition(width, "p").sortWithinPartitions("p").mapInArrow(B.tidy(_gather), NODE), "shingle-nodes")
    stats = nodes.where(F.col("kind") == B.STATS).select("id", "n", "d1", "d2")
    classes = saved(stats.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("id").alias("rep")), "set-classes")
    members = saved(
        stats.where("n > 0").join(classes, ["n", "d1", "d2"]).select("id", "n", "rep")
        .unionByName(stats.where("n = 0").select("id", "n", F.col("id").alias("rep"))),
        "members",
    )
    met = nodes.where(F.col("kind") == B.KNOWN).select("key", "id").join(members.select("id", "rep"), "id")
    met = saved(met.select("key", F.col("rep").alias("id")).distinct(), "met")
    dropped(nodes, classes)
    shared = saved(met.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "shared-keys")
    keyed = saved(met.join(shared, "key"), "blocks")
    dropped(met, shared)
    meets = keyed.groupBy("id").agg(F.count(F.lit(1)).alias("meets"))
    ids = saved(meets.select("id"), "wanted-ids")
    outlines = outlines_of(wanted_rows(docs, ids, id_col, text_col), words)
    check = lambda pairs: verified(pairs, docs, outlines, words, percent, id_col, text_col)
    share = meets.join(outlines.select("id", "n"), "id").select("id", (F.col("meets") / F.col("n")).alias("share"))
    blocks = saved(keyed.join(share, "id"), "shared-blocks")
    dropped(keyed, ids)
    hubs = hub_pairs(blocks.withColumn("part", F.col("id")))
    listed = listed_pairs(blocks.where(F.col("m") <= PAIRED))
    larger = blocks.where(F.col("m") > PAIRED)
    linked = saved(components(check(hubs)), "hub-components")
    # The trees join near components by their best pairs, then all pairs of those still apart.
    tried = hubs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found, read = open_pairs(larger, linked, outlines, percent, best=True)
    near = found.unionByName(still_apart(listed, linked)).distinct().join(tried, ["a", "b"], "left_anti")
    near = _saved_small(near, "near-pairs")
    dropped(listed, *read)
    linked = joined(linked, check(near))
    # Listed pairs have all been looked at by now.
    found, read = open_pairs(larger, linked, outlines, percent, best=False)
    left = _saved_small(found.join(tried.unionByName(near), ["a", "b"], "left_anti"), "open-pairs")
    dropped(blocks, hubs, near, *read)
    linked = joined(linked, check(left))
    dropped(outlines, left)
    placed = members.join(linked.withColumnRenamed("id", "rep"), "rep", "left").select(
        "id", "n", F.coalesce("component", "rep").alias("component")
    )
    return placed.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    ).unionByName(
        docs.where(F.col(id_col).isNull()).select(
            F.col(id_col).cast("long").alias(id_col), F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
        )
    )
