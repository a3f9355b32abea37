"""Suffix dedup: bytes inside a string of 50 that an earlier document has.

The suffixes of all documents, cut off at 50 bytes, in suffix order: equal ones
stand together, and the previous and next smaller document of each gives its
longest previous factor. Where that reaches 50 bytes, the string starts in an
earlier document too and is covered; the earliest keeps it.

Sorting every suffix of the corpus in one order would shuffle each byte 50
times. Instead each window of 50 bytes goes by its anchor, the smallest hash of
the 25 strings of 26 bytes in it (equal windows have equal anchors at the same
place), and neighbouring windows with one anchor travel as one piece.

1. Copies of whole texts are settled by digest.
2. Anchors that two documents have are found from 8-byte hashes alone.
3. Pieces at those anchors meet by anchor. Equal pieces are settled at once; the
   suffixes of pieces that differ are put into suffix order within their
   partition and their longest previous factors taken.
4. Covered ranges are joined to the texts and cut out.

An anchor with a thousandth of all rows or more (at most a thousand such) would
bring too many pieces together: its windows are dealt out by their own hash.
A task settles what repeats within it before the shuffle.

Defined cases: a null text is empty; texts under 50 bytes never match; a row
without id loses nothing and covers nothing; rows that repeat an id and a text
are one document, so they do not cover each other, and all of them lose what the
smallest id before them has; rows of an id with different texts cover later
documents and lose nothing, since spans are known by id alone. Anchors, whole pieces and heavy windows are
compared by 64-bit hashes, other suffixes by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm import bytes_np as B
from rillmark.llm.bytes_np import U64, mix
from rillmark.llm.common import saved, shuffle_width

SPAN = 50
GRAM = 26
WIDTH = SPAN - GRAM + 1  # anchor candidates in a window
MOST_ANCHORS = 750_000  # kept by a task before it passes them on
PART = 1 << 20
ROWS = 512  # texts decompressed together
BROADCAST_IDS = 1_000_000
HEAVY_SHARE, HEAVY_LEAST = 1000, 1000
TOGETHER = 20_000  # pieces put into suffix order together
PIECE = np.dtype([("start", "<i8"), ("before", "<u1"), ("count", "<u1")])
GONE, WINDOW, HEAVY = 11, 12, 13


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def few_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most `ROWS` texts: what is made of a batch's texts is held for the whole batch."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            yield whole.slice(at, ROWS)


def squeezed(rows: DataFrame) -> DataFrame:
    """id, body: with each text compressed before it is shuffled; null stays null."""
    schema = pa.schema([("id", pa.int64()), ("body", pa.binary())])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in few_rows(batches):
            body = [None if t is None else press.compress(t.encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(body, pa.binary())], schema=schema)

    return rows.select("id", "body").mapInArrow(B.tidy(over), "id long, body binary")


def window_hash(data: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n bytes from each place on."""
    up, down = (B.POWERS, B.INVERSE) if len(data) <= B.SEGMENT else (
        B.powers(B.BASE, len(data) + 1), B.powers(pow(B.BASE, -1, 1 << 64), len(data) + 1)
    )
    total = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(B.BYTE_VALUE[data] * up[: len(data)], out=total[1:])
    m = len(data) - n + 1
    return mix((total[n:] - total[:m]) * down[:m])


def pieces(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor's place after the first window's start, key) of each piece.

    `data` holds whole texts, one after another; `ends` says for each byte where its text ends.
    """
    none = np.zeros(0, dtype=np.int64)
    n = len(data) - SPAN + 1
    if n <= 0:
        return none, none, none, none.astype(U64)
    low = window_hash(data, GRAM) & ~U64(63)
    done = 1
    # The low six bits count from the window's start, so ties go to the leftmost.
    while done * 2 <= WIDTH:
        low = np.minimum(low[:-done], low[done:] + U64(done))
        done *= 2
    if done < WIDTH:
        low = np.minimum(low[: -(WIDTH - done)], low[WIDTH - done :] + U64(WIDTH - done))
    whole = np.flatnonzero(np.arange(n) + SPAN <= ends[:n])
    if not len(whole):
        return none, none, none, none.astype(U64)
    low = low[whole]
    anchor = whole + (low & U64(63)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1] + 1)]))
    first = whole[cut]
    return first, np.diff([*cut, len(whole)]), anchor[cut] - first, mix(low[cut] >> U64(6))


def text_parts(column: pa.Array, size: int = PART) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, text number, place in its text, end of its text) of parts of about `size` bytes.

    A longer text is cut at fixed places, each part with the SPAN - 1 bytes that follow it.
    """
    data, offsets = B.column_bytes(column)
    i = 0
    while i < len(offsets) - 1:
        j = i + 1
        while j < len(offsets) - 1 and offsets[j + 1] - offsets[i] <= size:
            j += 1
        a, b = int(offsets[i]), int(offsets[j])
        for lo in range(a, max(b, a + 1), size) if j == i + 1 else [a]:
            hi = min(b, lo + size + SPAN - 1) if j == i + 1 else b
            lengths = np.diff(np.clip(offsets[i : j + 1], lo, hi))
            text = np.repeat(np.arange(i, j), lengths)
            yield data[lo:hi], text, np.arange(lo, hi) - offsets[text], np.repeat(np.clip(offsets[i + 1 : j + 1], lo, hi) - lo, lengths)
        i = j


def _anchors(width: int, part: int) -> Callable:
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for data, text, place, ends in text_parts(batch.column(1), part):
                first, _, _, key = pieces(data, ends)
                held.append((key, ids[text[first]], place[first].astype(np.int32)))
                if sum(len(h[0]) for h in held) > MOST_ANCHORS:
                    yield from B.deal(*map(np.concatenate, zip(*held, strict=True)), width)
                    held = []
        if held:
            yield from B.deal(*map(np.concatenate, zip(*held, strict=True)), width)

    return over


SHARED = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("place", pa.int32()), ("key", pa.int64()), ("times", pa.int64())])
SHARED_DDL = "kind int, id long, place int, key long, times long"


def _shared(least: int) -> Callable:
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, place) of the pieces whose anchor another document has, and counts of frequent anchors."""

        def rows(docs: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
            n = len(docs)
            none = pa.nulls(n, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, B.KNOWN, np.int32)), pa.array(docs), pa.array(places), none, none], schema=SHARED)

        for found in B.parts_in_turn(batches):
            open_rows = []
            for r in found:
                if r["kind"] == B.OPEN:
                    open_rows.append((r["a"], r["b"], r["c"], r["d"]))
                else:
                    yield rows(B.from_planes(r["b"], np.int64), B.from_planes(r["d"], np.int32))
            _, docs, places, keys, times = B.settle(open_rows, least)
            yield rows(docs, places)
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, HEAVY, np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(keys.view(np.int64)), pa.array(times)],
                schema=SHARED,
            )

    return over


def spans(kind: int, docs: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    yield from B.packed(kind, (mix(docs.astype(U64)) % U64(width)).astype(np.int64), [docs, starts.astype(np.int64), lengths.astype(np.int64)])


def _earliest(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row the smallest document with its key."""
    order = np.argsort(key, kind="stable")
    starts = B.runs(key[order])
    out = np.zeros(len(key), dtype=np.int64)
    if len(key):
        out[order] = np.repeat(np.minimum.reduceat(doc[order], starts), np.diff([*starts, len(key)]))
    return out


def _cut_pieces(heavy: np.ndarray, width: int, part: int) -> Callable:
    """Pieces at shared anchors, packed by anchor; windows at heavy anchors, packed by their hash."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            wanted = batch.column(2)
            texts = pa.array([unsqueeze(z) for z in batch.column(1).to_pylist()], pa.large_binary())
            lists = np.asarray(wanted.values)
            at = np.asarray(wanted.offsets)
            for data, text, place, ends in text_parts(texts, part):
                if not len(data):
                    continue
                first, count, before, key = pieces(data, ends)
                # A place is asked for if (text, place) is among the lists.
                mine = np.arange(text[0], text[-1] + 1)
                asked = np.concatenate([[np.int64(-1)], *(lists[at[t] : at[t + 1]].astype(np.int64) + (np.int64(t) << 40) for t in mine)])
                ok = np.isin(place[first] + (text[first].astype(np.int64) << 40), asked)
                first, count, before, key = first[ok], count[ok], before[ok], key[ok]
                doc, start = ids[text[first]], place[first]
                hot = np.isin(B.short(key), heavy)
                if hot.any():
                    here = np.repeat(first[hot], count[hot])
                    here = here + np.arange(len(here)) - np.repeat(np.cumsum(count[hot]) - count[hot], count[hot])
                    window, of = window_hash(data, SPAN)[here], ids[text[here]]
                    later = of > _earliest(window, of)
                    yield from spans(GONE, of[later], place[here[later]], np.full(later.sum(), SPAN), width)
                    to = B.destination(window, width)
                    yield from B.packed(WINDOW, to[~later], [window[~later], of[~later], place[here[~later]].astype(np.int64)])
                first, count, before, key, doc, start = (x[~hot] for x in (first, count, before, key, doc, start))
                whole = piece_hash(data, first, count + SPAN - 1)
                later = doc > _earliest(whole ^ mix(key), doc)
                yield from spans(GONE, doc[later], start[later], count[later] + SPAN - 1, width)
                keep = np.flatnonzero(~later)
                # By destination and anchor: pieces that are alike lie together and compress well.
                keep = keep[np.lexsort((key[keep], B.destination(key[keep], width)))]
                meta = np.zeros(len(keep), dtype=PIECE)
                meta["start"], meta["before"], meta["count"] = start[keep], before[keep], count[keep]
                yield from _pack_pieces(key[keep], doc[keep], meta, data, first[keep], width)

    return over


def piece_hash(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of the `length` bytes from each `first` on, from their first and last windows and all between."""
    total = np.zeros(len(data) + 1, dtype=U64)
    up, down = (B.POWERS, B.INVERSE) if len(data) <= B.SEGMENT else (
        B.powers(B.BASE, len(data) + 1), B.powers(pow(B.BASE, -1, 1 << 64), len(data) + 1)
    )
    np.cumsum(B.BYTE_VALUE[data] * up[: len(data)], out=total[1:])
    return mix((total[first + length] - total[first]) * down[first] + length.astype(U64) * B.STEP)


def _pack_pieces(key: np.ndarray, doc: np.ndarray, meta: np.ndarray, data: np.ndarray, first: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of ROW with keys, documents, PIECE and bytes; the pieces are sorted by destination."""
    if not len(key):
        return
    to = B.destination(key, width)
    length = meta["count"].astype(np.int64) + SPAN - 1
    ends = np.cumsum(length)
    taken = data[np.repeat(first - (ends - length), length) + np.arange(ends[-1])]
    where, a = np.unique(to, return_index=True)
    b = [*a[1:], len(to)]
    cut = lambda x: [x[i:j].tobytes() for i, j in zip(a, b, strict=True)]
    body = [squeeze(taken[ends[i] - length[i] : ends[j - 1]].tobytes()) for i, j in zip(a, b, strict=True)]
    columns = [pa.array(where, pa.int32()), pa.array([B.OPEN] * len(a), pa.int32()), *(pa.array(x, pa.binary()) for x in (cut(key), cut(doc), cut(meta), body))]
    yield pa.RecordBatch.from_arrays(columns, schema=B.ROW)


def smaller_before(doc: np.ndarray, run: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it in its run with a smaller document, or -1."""
    at = np.arange(len(doc)) - 1
    at[run] = -1
    while True:
        go = (at >= 0) & (doc[at] >= doc)
        if not go.any():
            return at
        at[go] = at[at[go]]


def factors(key: np.ndarray, doc: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor of each suffix (rows of SPAN bytes) reaches SPAN.

    Suffixes with one key are put into suffix order. Between neighbours with a
    common prefix of SPAN bytes the longest previous factor is that of the
    nearest smaller document before or after; beyond them it is shorter.
    """
    words = np.zeros((len(key), 56), dtype=np.uint8)
    words[:, :SPAN] = suffixes
    columns = words.view(">u8").astype(U64)
    order = np.lexsort([*(columns[:, i] for i in range(6, -1, -1)), key])
    k, d, c = key[order], doc[order], columns[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1]).any(axis=1)])
    previous = smaller_before(d, np.flatnonzero(new)) >= 0
    last = np.concatenate([new[1:], [True]])
    following = smaller_before(d[::-1], np.flatnonzero(last[::-1]))[::-1] >= 0
    out = np.zeros(len(key), dtype=bool)
    out[order] = previous | following
    return out


def covered_windows(key: np.ndarray, doc: np.ndarray, meta: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of what is covered in gathered pieces."""
    count = meta["count"].astype(np.int64)
    length = count + SPAN - 1
    at = np.cumsum(length) - length
    # Pieces are compared by their bytes' hash; at most PART bytes of hash sums at a time.
    whole = np.zeros(len(key), dtype=U64)
    lo = 0
    while lo < len(key):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + PART - 256)))
        whole[lo:hi] = piece_hash(body[at[lo] : at[hi - 1] + length[hi - 1]], at[lo:hi] - at[lo], length[lo:hi])
        lo = hi
    same = whole ^ mix(key)
    order = np.lexsort([doc, same])
    starts = B.runs(same[order])
    head = order[starts]  # the earliest document's piece stands for all equal ones
    of = np.zeros(len(key), dtype=np.int64)
    of[order] = np.repeat(np.arange(len(starts)), np.diff([*starts, len(key)]))
    later = doc > doc[head[of]]
    docs, begins, lengths = [doc[later]], [meta["start"][later]], [length[later]]
    # Pieces that differ but have one anchor: suffix order.
    by_key = np.argsort(key[head], kind="stable")
    groups = B.runs(key[head][by_key])
    several = np.repeat(np.diff([*groups, len(head)]) > 1, np.diff([*groups, len(head)]))
    chosen = by_key[several]
    suffixes = np.lib.stride_tricks.sliding_window_view(body, SPAN)
    bounds = np.flatnonzero(np.concatenate([[True], key[head[chosen]][1:] != key[head[chosen]][:-1]])) if len(chosen) else []
    cover: dict[int, np.ndarray] = {}
    lo = 0
    while lo < len(chosen):
        far = np.searchsorted(bounds, lo + TOGETHER)
        hi = int(bounds[far]) if far < len(bounds) else len(chosen)
        if hi <= lo:
            hi = len(chosen)
        part = head[chosen[lo:hi]]
        n = count[part]
        row = np.repeat(np.arange(len(part)), n)
        t = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        # Equal windows stand at the same distance from their anchor.
        slot = key[part][row] ^ mix((meta["before"][part][row].astype(np.int64) - t + 64).astype(U64))
        hit = factors(slot, doc[part][row], suffixes[at[part][row] + t])
        ends = np.cumsum(n)
        for r in np.unique(row[hit]):
            own = slice(ends[r] - n[r], ends[r])
            cover[int(chosen[lo + r])] = t[own][hit[own]]
        lo = hi
    if cover:
        for i in np.flatnonzero(~later & np.isin(of, np.fromiter(cover, dtype=np.int64))):
            t = cover[int(of[i])]
            docs.append(np.full(len(t), doc[i]))
            begins.append(meta["start"][i] + t)
            lengths.append(np.full(len(t), SPAN))
    return np.concatenate(docs), np.concatenate(begins), np.concatenate(lengths)


COVERED = pa.schema([("id", pa.int64()), ("span", pa.int64())])
LENGTH_BITS = 8


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, span (start and length in one number) of covered ranges."""

    def rows(doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array((start << LENGTH_BITS) | length)], schema=COVERED)

    join = lambda found, c, kind: np.frombuffer(b"".join(r[c] for r in found), dtype=kind)
    for found in B.parts_in_turn(batches):
        met, windows = [], []
        for r in found:
            if r["kind"] == GONE:
                yield rows(*(np.frombuffer(r[c], dtype=np.int64) for c in "abc"))
            elif r["kind"] == WINDOW:
                windows.append(r)
            else:
                met.append(r)
        if windows:
            key, doc, start = join(windows, "a", U64), join(windows, "b", np.int64), join(windows, "c", np.int64)
            later = doc > _earliest(key, doc)
            yield rows(doc[later], start[later], np.full(later.sum(), SPAN))
        if met:
            yield rows(*covered_windows(join(met, "a", U64), join(met, "b", np.int64), join(met, "c", PIECE), np.frombuffer(b"".join(unsqueeze(r["d"]) for r in met), np.uint8)))


RESULT = pa.schema(
    [("id", pa.int64()), ("body", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


def _remove(with_text: bool, pressed: bool) -> Callable:
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            out = []
            for i, text, copy, found in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3), strict=True):
                data = b"" if text is None else unsqueeze(text) if pressed else text.encode()
                n = len(data)
                gone = np.full(n, bool(copy) and n >= SPAN)
                if found.is_valid and not copy:
                    span = np.asarray(found.values)
                    edge = np.zeros(n + 1, dtype=np.int64)
                    start = span >> LENGTH_BITS
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + (span & (1 << LENGTH_BITS) - 1), -1)
                    gone = np.cumsum(edge[:n]) > 0
                left = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                begins = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
                out.append((i, left if with_text else None, n, int(gone.sum()), begins, hashlib.sha256(left).hexdigest()))
            columns = zip(*out, strict=True) if out else [[]] * len(RESULT)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, RESULT.types, strict=True)], schema=RESULT)

    return over


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True,
    heavy_least: int = HEAVY_LEAST, heavy_share: int = HEAVY_SHARE, part: int = PART,
) -> DataFrame:
    """One row per document: id, text (the bytes left; null without `with_text`), n_bytes, n_removed, n_spans, kept_sha256.

    The last three parameters say when an anchor is heavy and how many bytes are
    looked at together; they change the way, never the result.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    many = width * B.SPREAD
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    known = rows.where("id IS NOT NULL")
    texts_of = known.groupBy("id").agg(F.min(F.xxhash64("body")).alias("low"), F.max(F.xxhash64("body")).alias("high"))
    shared_ids = saved(texts_of.where("low <> high").select("id"), "shared-ids")
    n_shared = shared_ids.count()

    def of_one_text(df: DataFrame) -> DataFrame:
        # What is found of one text must not be taken out of another of the same id.
        if not n_shared:
            return df
        return df.join(F.broadcast(shared_ids) if n_shared <= BROADCAST_IDS else shared_ids, "id", "left_anti")

    digests = known.where(F.octet_length("body") >= SPAN).select("id", F.sha2(F.col("body").cast("binary"), 256).alias("digest"))
    groups = digests.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = saved(groups.select("digest", "first"), "text-groups")
    copies = saved(of_one_text(digests.join(groups, "digest").where("id > first").select("id").distinct()), "copies")
    aside = F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies
    texts = known.where(F.octet_length("body") >= SPAN).join(aside, "id", "left_anti")
    packed = texts.mapInArrow(B.tidy(_anchors(many, part)), B.ROW_DDL)
    shared = saved(packed.repartition(width, "p").sortWithinPartitions("p").mapInArrow(B.tidy(_shared(heavy_least)), SHARED_DDL), "shared-anchors")
    total = shared.where(F.col("kind") == B.KNOWN).count()
    # At most heavy_share keys can have that share of the rows.
    frequent = shared.where((F.col("kind") == HEAVY) & (F.col("times") * heavy_share >= total)).select("key").distinct()
    heavy = np.array([r.key for r in frequent.collect()], dtype=np.int64).view(U64)
    places = shared.where(F.col("kind") == B.KNOWN).groupBy("id").agg(F.collect_list("place").alias("places"))
    asked = squeezed(texts).join(places, "id").select("id", "body", "places")
    met = asked.mapInArrow(B.tidy(_cut_pieces(heavy, many, part)), B.ROW_DDL).repartition(width, "p").sortWithinPartitions("p")
    covered = saved(met.mapInArrow(B.tidy(_cover), "id long, span long"), "covered")
    ranges = of_one_text(covered).groupBy("id").agg(F.collect_list("span").alias("spans"))
    marked = copies.withColumn("copy", F.lit(True)).join(ranges, "id", "full")
    ddl = "id long, body binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    marked = saved(marked, "marked")
    ids = marked.select("id")
    names = {"id": id_col, "body": text_col}
    if marked.count() <= BROADCAST_IDS:
        # Only texts that lose something are shuffled.
        touched = squeezed(rows.join(F.broadcast(ids), "id", "left_semi"))
        clean = rows.join(F.broadcast(ids), "id", "left_anti")
        bare = clean.select("id", "body", F.lit(None).cast("boolean").alias("copy"), F.lit(None).cast("array<bigint>").alias("spans"))
        cut = touched.join(marked, "id").select("id", "body", "copy", "spans").mapInArrow(B.tidy(_remove(with_text, True)), ddl)
        return cut.unionByName(bare.mapInArrow(B.tidy(_remove(with_text, False)), ddl)).withColumnsRenamed(names)
    whole = squeezed(rows).join(marked, "id", "left").select("id", "body", "copy", "spans")
    return whole.mapInArrow(B.tidy(_remove(with_text, True)), ddl).withColumnsRenamed(names)
