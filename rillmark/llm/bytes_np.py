"""Numpy helpers on whole Arrow text columns: bytes, words, 64-bit hashes, packed rows.

Packed rows carry arrays of keys as binary columns, so Spark shuffles a few
large rows instead of one per key. What a task knows to be repeated by itself
is settled there, and only one row per key and task meets in the shuffle: a key
that fills a third of the table sends one row per task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20  # bytes looked at together
U64 = np.uint64
MIX_A, MIX_B, STEP = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
ROW = pa.schema([("p", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in "abcd")])
ROW_DDL = "p int, kind int, a binary, b binary, c binary, d binary"
OPEN, KNOWN, STATS = 0, 1, 2
SHORT = U64((1 << 40) - 1)
SPREAD = 8  # packed destinations per shuffle partition, for an even deal


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the output (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * MIX_A
    x = (x ^ (x >> U64(27))) * MIX_B
    return x ^ (x >> U64(31))


def odd(n: int, seed: int) -> np.ndarray:
    """n fixed odd multipliers."""
    return mix(np.arange(1, n + 1, dtype=U64) * STEP + U64(seed)) | U64(1)


BYTE_VALUE = odd(256, 7)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 offsets of its texts; null is empty."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column, b"" if binary else "").cast(pa.large_binary() if binary else pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(max(n, 1), base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


BASE = 0x5851F42D4C957F2D
POWERS = powers(BASE, SEGMENT + 1)
INVERSE = powers(pow(BASE, -1, 1 << 64), SEGMENT + 1)


def word_hashes(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word of every text; `gap` marks the bytes between words."""
    hashes, texts, lo = [], [], 0
    while lo < len(data):
        hi = min(lo + SEGMENT, len(data))
        if hi < len(data):  # end where no word goes on
            back = np.flatnonzero(gap[data[lo:hi]])
            edge = offsets[np.searchsorted(offsets, hi, "right") - 1]
            hi = max(lo + int(back[-1]) + 1 if len(back) else lo, int(edge))
            if hi <= lo:  # one word longer than a segment: up to its end
                ahead = np.flatnonzero(gap[data[lo:]])
                hi = min(lo + int(ahead[0]) + 1 if len(ahead) else len(data), int(offsets[np.searchsorted(offsets, lo, "right")]))
        part = data[lo:hi]
        between = gap[part]
        first = np.zeros(len(part) + 1, dtype=bool)
        first[offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, "right")] - lo] = True
        first[0] = first[-1] = True
        inside = ~between
        starts = np.flatnonzero(inside & (first[:-1] | np.concatenate([[True], between[:-1]])))
        ends = np.flatnonzero(inside & (first[1:] | np.concatenate([between[1:], [True]]))) + 1
        n = len(part)
        up, down = (POWERS, INVERSE) if n <= SEGMENT else (powers(BASE, n + 1), powers(pow(BASE, -1, 1 << 64), n + 1))
        total = np.zeros(n + 1, dtype=U64)
        np.cumsum(BYTE_VALUE[lower[part]] * up[:n], out=total[1:])
        value = (total[ends] - total[starts]) * down[starts]
        hashes.append(mix(value + (ends - starts).astype(U64) * STEP))
        texts.append(np.searchsorted(offsets, starts + lo, "right") - 1)
        lo = hi
    if not hashes:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(texts)


def packed(kind: int, p: np.ndarray, columns: list[np.ndarray], key: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows of ROW: for each destination p the arrays of what goes there, in the given order.

    With `key`, columns are sent as planes, and of the first only the `short` part.
    """
    if not len(p):
        return
    order = np.argsort(p, kind="stable")
    where, starts = np.unique(p[order], return_index=True)
    ends = [*starts[1:], len(p)]
    dealt = [c[order] for c in columns]
    ways = [key_planes if key and not i else planes if key else np.ndarray.tobytes for i in range(len(dealt))]
    blobs = [[way(c[a:b]) for a, b in zip(starts, ends, strict=True)] for c, way in zip(dealt, ways, strict=True)]
    blobs += [[b""] * len(where)] * (4 - len(columns))
    arrays = [pa.array(where, pa.int32()), pa.array([kind] * len(where), pa.int32()), *(pa.array(b, pa.binary()) for b in blobs)]
    yield pa.RecordBatch.from_arrays(arrays, schema=ROW)


def planes(x: np.ndarray) -> bytes:
    """The bytes of an array, all lowest bytes first: high bytes that hardly change compress to nothing."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def short(keys: np.ndarray) -> np.ndarray:
    """The part of keys that is sent; a destination says the rest but for its remainder.

    Two keys may then look alike (once in 2^40 times the number of destinations),
    which can only make a pair of documents be compared in vain.
    """
    return keys & SHORT


def destination(keys: np.ndarray, width: int) -> np.ndarray:
    return ((keys >> U64(40)) % U64(width)).astype(np.int64)


def key_planes(keys: np.ndarray) -> bytes:
    return planes(keys)[: 5 * len(keys)]


def from_key_planes(data: bytes) -> np.ndarray:
    return from_planes(data + bytes(len(data) // 5 * 3), U64)


def runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal sorted keys starts."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)


def deal(keys: np.ndarray, docs: np.ndarray, places: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """One task's (key, doc, place) rows, packed: one row of each key, and what the task knows to be repeated."""
    order = np.argsort(keys, kind="stable")
    starts = runs(keys[order])
    sorted_docs = docs[order]
    several = np.minimum.reduceat(sorted_docs, starts) != np.maximum.reduceat(sorted_docs, starts) if len(starts) else np.zeros(0, bool)
    rest = np.ones(len(keys), dtype=bool)
    rest[order[starts]] = False
    size = np.diff([*starts, len(keys)])
    mark = np.zeros(len(keys), dtype=np.uint32)  # rows of the key in this task, if of several documents
    mark[order] = np.repeat(np.where(several, size, 0), size)
    # Of a key with one document in the task all rows go on; of one with several, the first row does.
    on = ~rest | (mark == 0)
    yield from packed(OPEN, destination(keys[on], width), [keys[on], docs[on], mark[on], places[on]], key=True)
    off = ~on
    to = destination(mix(docs[off].astype(U64)), width)
    yield from packed(KNOWN, to, [keys[off], docs[off], mark[off], places[off]], key=True)


def settle(rows: list[tuple[bytes, bytes, bytes, bytes]], heavy: int = 0) -> tuple[np.ndarray, ...]:
    """(keys, docs, places) of the gathered OPEN rows whose key is in two documents or more.

    With `heavy`, also (keys, counts) of all keys with at least that many rows in the table.
    """
    keys, docs, mark, places = (
        np.concatenate([np.zeros(0, kind), *(from_key_planes(r[i]) if not i else from_planes(r[i], kind) for r in rows)])
        for i, kind in enumerate((U64, np.int64, np.uint32, np.int32))
    )
    if not len(keys):
        return (keys, docs, places, keys, docs) if heavy else (keys, docs, places)
    order = np.argsort(keys, kind="stable")
    starts = runs(keys[order])
    by = docs[order]
    twice = (np.minimum.reduceat(by, starts) != np.maximum.reduceat(by, starts)) | (np.maximum.reduceat(mark[order], starts) > 0)
    keep = order[np.repeat(twice, np.diff([*starts, len(keys)]))]
    if not heavy:
        return keys[keep], docs[keep], places[keep]
    count = np.add.reduceat(np.maximum(mark[order], 1).astype(np.int64), starts)
    return keys[keep], docs[keep], places[keep], keys[order[starts]][count >= heavy], count[count >= heavy]


def parts_in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each `p`, one list after the other; the rows come sorted by it, so no more than one is held."""
    held: list[dict] = []
    for batch in batches:
        for at in range(batch.num_rows):
            (row,) = batch.slice(at, 1).to_pylist()
            if held and held[0]["p"] != row["p"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Freed memory goes back to the system: workers live on and wait beside the JVM."""
    pa.default_memory_pool().release_unused()
    if TRIM is not None:
        TRIM(0)


def slices(batches: Iterator[pa.RecordBatch], column: int, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of up to `rows` rows whose texts have about a SEGMENT of bytes together, or of one longer text."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        lo = 0
        while lo < batch.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = min(max(lo + 1, int(np.searchsorted(ends, before + SEGMENT, "right"))), lo + rows)
            yield batch.slice(lo, min(hi, batch.num_rows) - lo)
            lo = hi


def tidy(over: Callable) -> Callable:
    """`over`, after which the worker gives freed memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from over(batches)
        give_back()

    return run
