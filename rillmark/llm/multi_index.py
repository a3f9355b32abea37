"""Nearest neighbours by cosine through an inverted multi-index.

Vectors are brought to unit length and cut in two halves. Each half is quantised
with its own centroids, learned by k-means from a bounded sample; a pair of
centroids is a cell. A query walks the cells by rising sum of its two distances,
taken from a heap, until they hold enough entries, and these are ranked by their
cosine with the original vectors.

How many entries are enough is measured, not guessed: for a few queries the true
neighbours are found by one pass over all entries, and the walk is made as long
as `recall` of them need. Vectors without structure need a large share of all
entries, clustered ones a small one.

Every row is indexed. Cells are dealt to shards of about `SHARD_ROWS` entries; a
larger cell is cut over several. A query goes once to each shard in which it
visits a cell, and entries meet queries shard by shard: a task holds one shard's
entries and streams the queries, so neither a full cell nor a cell that many
queries ask for has to fit in memory. Of equal vectors in a shard only the ids
that can be reported are compared.

Bounds: `SAMPLE` vectors for k-means and `TRIAL` queries come to the driver; the
centroids and the counts of at most `SIDE` squared cells go to the workers.

Defined cases: vectors that are null, empty, zero or hold a null, NaN or
infinity, and rows without id, take no part; of several lengths the most
frequent takes part (of equally frequent ones the shortest). Ids that stand for
several vectors are as near as their nearest ones. Equal cosines are ordered by
id. A query's own id is no candidate. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.llm.common import saved, shuffle_width

SAMPLE = 20_000  # vectors that k-means sees
ROUNDS = 10  # of k-means
SIDE = 1024  # centroids of a half at most
CELL_ROWS = 16  # entries per cell aimed at, below that many centroids
TRIAL = 200  # queries whose true neighbours set the length of the walk
SHARD_ROWS = 4096
QUERY_ROWS = 512  # compared with a shard at a time
#: Sums taken in another order differ by less; finalists are summed again in one order.
SLACK = 1e-9

Batches = Iterator[pa.RecordBatch]


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows, each times a power of two that keeps squares finite."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), len(flat) // max(1, len(column)))
    _, exponent = np.frexp(np.abs(rows).max(axis=1, initial=0.0))
    return np.ldexp(rows, -exponent[:, None])


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.add.reduce(rows * rows, axis=1))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / _lengths(rows)[:, None]


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared, up to what is the same for all centroids of a point."""
    return np.add.reduce(centroids * centroids, axis=1) - 2 * points @ centroids.T


def k_means(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most k centroids, fewer where there are fewer different points."""
    different = np.unique(points, axis=0)
    chosen = np.random.default_rng(0).permutation(len(different))[:k]
    centroids = different[chosen]
    for _ in range(rounds):
        nearest = _distances(points, centroids).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


def walk(left: np.ndarray, right: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells by rising sum of two distances until they hold `enough` entries.

    A cell enters the heap once the cells before it in its row and column have
    left it, so a walk looks at little more than what it takes.
    """
    rows, columns = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    a, b = left[rows].tolist(), right[columns].tolist()
    taken, held, done = [], 0, [0] * (len(a) + 1)  # done[i]: cells taken from row i
    heap = [(a[0] + b[0], 0, 0)]
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(rows[i]) * len(b) + int(columns[j])
        if counts[cell]:
            taken.append(cell)
            held += int(counts[cell])
        done[i] = j + 1
        if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and done[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
    return taken


@dataclass(frozen=True)
class Codebook:
    """The centroids of both halves."""

    left: np.ndarray
    right: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.left) * len(self.right)

    def split(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of each vector's halves to the centroids."""
        unit, half = _unit(rows), self.left.shape[1]
        return _distances(unit[:, :half], self.left), _distances(unit[:, half:], self.right)

    def cell(self, rows: np.ndarray) -> np.ndarray:
        left, right = self.split(rows)
        return left.argmin(axis=1) * len(self.right) + right.argmin(axis=1)


@dataclass(frozen=True)
class MultiIndex:
    """Every sound vector with its cell, and what a search needs to know of them."""

    book: Codebook
    counts: np.ndarray  # entries of each cell
    entries: DataFrame  # id, vec, cell

    @property
    def size(self) -> int:
        return int(self.counts.sum())


def sound(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, vec: rows that have an id and a direction."""
    element = vectors.schema[vec_col].dataType.elementType
    vec = F.col(vec_col) if isinstance(element, (T.FloatType, T.DoubleType)) else F.col(vec_col).cast("array<double>")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    )


def spread(ids: Column) -> Column:
    """An order of ids that has nothing to do with their values."""
    return F.xxhash64(ids)


def build(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> MultiIndex | None:
    """Learns the centroids from a sample and writes every row with its cell; None for an empty table."""
    rows = sound(vectors, id_col, vec_col)
    length = F.size("vec").alias("length")
    most = rows.groupBy(length).count().orderBy(F.desc("count"), "length").first()
    if most is None:
        return None
    rows, n = rows.where(F.size("vec") == most["length"]), most["count"]
    sample = rows.orderBy(spread(F.col("id")), "id").limit(SAMPLE).select("vec").toArrow()
    points = _unit(_matrix(sample.column(0).combine_chunks()))
    half = points.shape[1] // 2
    side = int(min(SIDE, max(2, round((n / CELL_ROWS) ** 0.5))))
    book = Codebook(k_means(points[:, :half], side), k_means(points[:, half:], side))

    def assign(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                cells = pa.array(book.cell(_matrix(batch.column(1))), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, cells], [*batch.schema.names, "cell"])

    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])
    entries = saved(rows.mapInArrow(assign, schema), "multi-index")
    counts = np.zeros(book.cells, dtype=np.int64)
    for row in entries.groupBy("cell").count().collect():  # at most SIDE squared rows
        counts[row["cell"]] = row["count"]
    return MultiIndex(book, counts, entries)


def _arrow_type(rows: DataFrame) -> pa.DataType:
    single = isinstance(rows.schema["vec"].dataType.elementType, T.FloatType)
    return pa.list_(pa.float32() if single else pa.float64())


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """(place, id) of the k nearest other ids, nearest first; of an id only its nearest vector."""
    found, seen = [], {own}
    for at in np.lexsort((ids, -scores)):
        if (one := int(ids[at])) not in seen:
            seen.add(one)
            found.append((int(at), one))
            if len(found) == k:
                break
    return found


def _compare(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, allowed: np.ndarray | None = None
) -> Iterator[tuple[int, int, int, float]]:
    """(query, place, id, cosine) of the k nearest rows of each query.

    One matrix product leaves few finalists; these are summed again element by
    element in one order, so equal vectors get equal cosines wherever they stand.
    """
    lengths, own = _lengths(rows), _lengths(queries)
    near = queries @ rows.T / lengths / own[:, None]
    if allowed is not None:
        near[~allowed] = -np.inf
    near[query_ids[:, None] == ids] = -np.inf
    # Ids may repeat, so the k-th best vector is no bound for the k-th best id unless they do not.
    single = len(np.unique(ids)) == len(ids)
    if single and k < len(ids):
        least = np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k] - SLACK
    else:
        least = np.full(len(queries), -2.0)
    for q in range(len(queries)):
        final = np.flatnonzero((near[q] >= least[q]) & (near[q] > -np.inf))
        scores = np.add.reduce(rows[final] * queries[q], axis=1) / (lengths[final] * own[q])
        for at, one in _best(scores, ids[final], int(query_ids[q]), k):
            yield q, int(final[at]), one, float(scores[at])


def _reportable(rows: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of rows that can be among the k nearest: of equal vectors those with the k + 1 smallest ids."""
    left: dict[bytes, list[int]] = {}
    keep = []
    for at in np.argsort(ids, kind="stable"):
        seen = left.setdefault(rows[at].tobytes(), [])
        if len(seen) <= k and (not seen or seen[-1] != ids[at]):
            seen.append(int(ids[at]))
            keep.append(at)
    return np.sort(np.array(keep, dtype=np.int64))


def enough_entries(index: MultiIndex, queries: DataFrame, k: int, recall: float, trial: int = TRIAL) -> int:
    """How many entries a walk must see so that `recall` of the true neighbours are among them.

    `queries` (id, vec) are sampled down to `trial`, and one pass over all
    entries finds their k nearest.
    """
    sample = queries.orderBy(spread(F.col("id")), "id").limit(trial).toArrow()
    if not sample.num_rows:
        return 0
    ids, rows = sample.column("id").to_numpy(), _matrix(sample.column("vec").combine_chunks())

    def nearest(batches: Batches) -> Batches:
        best: list[list[tuple[float, int, int]]] = [[] for _ in ids]
        for whole in batches:
            for at in range(0, whole.num_rows, SHARD_ROWS):
                batch = whole.slice(at, SHARD_ROWS)
                mine, there, cells = batch.column("id").to_numpy(), _matrix(batch.column("vec")), batch.column("cell").to_numpy()
                keep = _reportable(there, mine, k)
                for q, place, one, score in _compare(rows, ids, there[keep], mine[keep], k):
                    best[q].append((-score, one, int(cells[keep[place]])))
                best = [sorted(b)[:k] for b in best]
        flat = [(q, one, cell, -minus) for q, b in enumerate(best) for minus, one, cell in b]
        columns = list(zip(*flat, strict=True)) or [(), (), (), ()]
        types = (pa.int32(), pa.int64(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["q", "id", "cell", "score"])

    found = index.entries.mapInArrow(nearest, "q int, id long, cell int, score double")
    top = _ranked(found, "q", "id", k).collect()  # k rows for each query of the trial
    if not top:
        return index.size
    left, right = index.book.split(rows)
    needed = []
    for q in range(len(rows)):
        order = np.argsort((left[q][:, None] + right[q]).ravel(), kind="stable")
        seen = np.empty(index.book.cells, dtype=np.int64)
        seen[order] = np.cumsum(index.counts[order])
        needed += [int(seen[r["cell"]]) for r in top if r["q"] == q]
    needed.sort()
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]


def _ranked(found: DataFrame, query: str, candidate: str, k: int) -> DataFrame:
    """The k best candidates of each query; Spark keeps k rows per query and task before the shuffle."""
    order = Window.partitionBy(query).orderBy(F.desc("score"), candidate)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


@dataclass(frozen=True)
class Plan:
    """Which shards hold a cell: `slices` shards from `first` on."""

    first: np.ndarray
    slices: np.ndarray

    def shard(self, cells: np.ndarray, ids: np.ndarray) -> np.ndarray:
        mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first[cells] + (mixed % self.slices[cells].astype(np.uint64)).astype(np.int64)


def deal(counts: np.ndarray, rows: int = SHARD_ROWS) -> Plan:
    """Cells in order, small ones together, each large one over shards of its own."""
    first, slices = np.zeros(len(counts), dtype=np.int64), np.ones(len(counts), dtype=np.int64)
    shard, held = 0, 0
    for cell, n in enumerate(counts.tolist()):
        if n > rows:
            shard += held > 0
            first[cell], slices[cell], held = shard, -(-n // rows), 0
            shard += int(slices[cell])
            continue
        if held + n > rows:
            shard, held = shard + 1, 0
        first[cell] = shard
        held += n
    return Plan(first, slices)


def search(
    index: MultiIndex | None, queries: DataFrame, k: int = 5, recall: float = 0.95,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every sound query.

    Queries of another length than the index are left out.
    """
    spark = queries.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = index.book.left.shape[1] + index.book.right.shape[1]
    asked = sound(queries, id_col, vec_col).where(F.size("vec") == size)
    asked = asked.withColumn("vec", F.col("vec").cast(index.entries.schema["vec"].dataType))
    enough = enough_entries(index, asked, k, recall)
    book, counts, plan = index.book, index.counts, deal(index.counts)
    vec_type = _arrow_type(index.entries)
    names = ["shard", "kind", "id", "vec", "cells"]
    arrow = pa.schema([("shard", pa.int32()), ("kind", pa.int8()), ("id", pa.int64()), ("vec", vec_type), ("cells", pa.list_(pa.int32()))])

    def place(batches: Batches) -> Batches:
        for batch in batches:
            ids, cells = batch.column("id").to_numpy(), batch.column("cell").to_numpy()
            shards = pa.array(plan.shard(cells, ids), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(range(len(ids) + 1), pa.int32()), pa.array(cells, pa.int32()))
            kind = pa.array(np.zeros(len(ids), dtype=np.int8))
            yield pa.RecordBatch.from_arrays([shards, kind, batch.column("id"), batch.column("vec").cast(vec_type), lists], schema=arrow)

    def route(batches: Batches) -> Batches:
        for whole in batches:
            for at in range(0, whole.num_rows, QUERY_ROWS):
                batch = whole.slice(at, QUERY_ROWS)
                left, right = book.split(_matrix(batch.column("vec")))
                shards: list[int] = []
                rows: list[int] = []
                visits: list[np.ndarray] = []
                for q in range(batch.num_rows):
                    cells = np.array(walk(left[q], right[q], counts, enough), dtype=np.int64)
                    repeated = np.repeat(cells, plan.slices[cells])
                    step = np.arange(len(repeated)) - np.repeat(np.cumsum(plan.slices[cells]) - plan.slices[cells], plan.slices[cells])
                    there = plan.first[repeated] + step
                    order = np.argsort(there, kind="stable")
                    own, starts = np.unique(there[order], return_index=True)
                    shards += own.tolist()
                    rows += [q] * len(own)
                    visits += np.split(repeated[order], starts[1:]) if len(own) else []
                if not shards:
                    continue
                taken = pa.array(rows, pa.int64())
                kind = pa.array(np.ones(len(rows), dtype=np.int8))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards, pa.int32()), kind, batch.column("id").take(taken), batch.column("vec").take(taken).cast(vec_type),
                     pa.array(visits, pa.list_(pa.int32()))],
                    schema=arrow,
                )

    schema = T.StructType(
        [T.StructField("shard", T.IntegerType()), T.StructField("kind", T.ByteType()), T.StructField("id", T.LongType()),
         index.entries.schema["vec"], T.StructField("cells", T.ArrayType(T.IntegerType()))]
    )
    met = (
        index.entries.mapInArrow(place, schema).unionByName(asked.mapInArrow(route, schema).select(*names))
        .repartition(shuffle_width(spark), "shard").sortWithinPartitions("shard", "kind")
    )
    found = met.mapInArrow(_meet(k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return _ranked(best, "query_id", "vec_id", k).select("query_id", "rank", "vec_id", "score")


def _meet(k: int) -> Callable[[Batches], Batches]:
    """Entries of a shard come before its queries: they are held, the queries pass by."""

    def over(batches: Batches) -> Batches:
        shard, rows, ids, cells, open_parts = None, None, None, None, []
        for whole in batches:
            shards, kinds = whole.column("shard").to_numpy(), whole.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(shards) != 0) | (np.diff(kinds) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(shards)], strict=True):
                if start == end:
                    continue
                if shards[start] != shard:
                    shard, rows, open_parts = shards[start], None, []
                part = whole.slice(start, end - start)
                if kinds[start] == 0:
                    open_parts.append((_matrix(part.column("vec")), part.column("id").to_numpy(), part.column("cells").flatten().to_numpy()))
                    continue
                if open_parts:
                    rows, ids, cells = (np.concatenate(x) for x in zip(*open_parts, strict=True))
                    keep = _reportable(rows, ids, k)
                    rows, ids, cells, open_parts = rows[keep], ids[keep], cells[keep], []
                if rows is None:
                    continue  # only empty cells
                for at in range(0, part.num_rows, QUERY_ROWS):
                    some = part.slice(at, QUERY_ROWS)
                    lists = some.column("cells")
                    asker = np.repeat(np.arange(len(some)), np.diff(lists.offsets.to_numpy()))
                    local = {c: i for i, c in enumerate(np.unique(cells).tolist())}
                    wanted = np.zeros((len(some), len(local) + 1), dtype=bool)
                    wanted[asker, [local.get(c, len(local)) for c in lists.flatten().to_numpy().tolist()]] = True
                    allowed = wanted[:, [local[c] for c in cells.tolist()]]
                    own = some.column("id").to_numpy()
                    out = [
                        (int(own[q]), one, score)
                        for q, _, one, score in _compare(_matrix(some.column("vec")), own, rows, ids, k, allowed)
                    ]
                    columns = list(zip(*out, strict=True)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                        ["query_id", "vec_id", "score"],
                    )

    return over

