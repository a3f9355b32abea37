"""Aligning the tokens of two tokenizers over the same bytes.

Tokens of both sides that share bytes belong together. Every token points to the
token that reaches farthest to the right among those it overlaps; doubling the
pointers (each step points to where its target points) takes every token to the
last token of its component, which names the group. Many texts are doubled
together, in as many steps as the logarithm of the longest chain.

A text is taken in units of white space and what follows it, where both
tokenizers start anew: words come again and again, so a worker encodes and
aligns a unit once and remembers it, those that came again for longest. New units
are encoded in runs, one after another as in a text, and a run that does not end
its tokens where its units end, unit by unit. Texts with characters on which engines may
not agree what is white space or a letter are one unit of their own, and so are
texts with white space that a piece of B joins to what stands before it.

Two passes over links, one over texts. The first pass takes documents in blocks
of at most `BLOCK_BYTES` of text (or one longer text) and writes one row per
block: the figures of its documents, their units, the links of the units as
places in the block's list of different id pairs, and that list with its counts.
The counts are added up over all blocks, the highest per B id is found, and both
go back to the blocks that have the pair, one row per block and pair: not per
link or document. A pair that stands everywhere has one row per block.

Broadcast or collected: nothing. A task holds one block, the tokenizers and at
most `REMEMBERED` bytes of units.

Defined cases: a null or empty text, and one whose tokens do not give its bytes
back on either side (such as bytes that are no UTF-8), has no tokens: zeros and
an empty string for the groups. Rows repeated with one id are rows of their own.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.byte_bpe import byte_letters
from rillmark.llm.common import saved

BLOCK_BYTES = 2 << 20
CALL_BYTES = 256 << 10  # encoded in one call: an encoder's own results are much larger than the ids
RUN = 256  # units encoded as one text
SHORT = 64  # units of more characters are not remembered
REMEMBERED = 48 << 20  # bytes of remembered units, about
SPACE_MARK = "▁"
# White space, and text in which every engine agrees on white space, letters and digits: Latin letters and signs.
WHITE = "\t-\r "
UNIT = re.compile(f"[{WHITE}]+[^{WHITE}]*")
PLAIN = re.compile(f"[{WHITE}\x21-\x7e\xa1-\xac\xae-\u024f]*")
BLOCK = (
    "block long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, unit_stops binary, units binary, link_stops binary, links binary, "
    "a array<int>, b array<int>, n array<long>"
)
PARTS = [
    ("ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
    ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("groups_sha256", pa.list_(pa.string())),
    ("unit_stops", pa.binary()), ("units", pa.binary()), ("link_stops", pa.binary()), ("links", pa.binary()),
    ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("n", pa.list_(pa.int64())),
]
BLOCK_ARROW = pa.schema([("block", pa.int64()), *PARTS])


A, B, GROUPS, LINKS, CHARS = range(5)


class Aligned(NamedTuple):
    """Alignments of units, one after another; a unit that does not give its bytes back has no tokens."""

    whole: np.ndarray
    sizes: np.ndarray  # of each unit: tokens of A and of B, groups, links, characters of its text
    text: str  # the groups of all units, each with a `;` behind it
    links: np.ndarray  # 64-bit numbers: A id times the size of B's vocabulary plus B id

    def texts(self) -> list[str]:
        ends = np.cumsum(self.sizes[:, CHARS], dtype=np.int64).tolist()
        return [self.text[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def chosen(self, rows: np.ndarray) -> Aligned:
        """The units at these places, in this order."""
        sizes = self.sizes[rows]
        ends = np.cumsum(self.sizes[:, CHARS], dtype=np.int64)[rows]
        text = "".join([self.text[a:b] for a, b in zip((ends - sizes[:, CHARS]).tolist(), ends.tolist(), strict=True)])
        many, starts = sizes[:, LINKS], np.cumsum(self.sizes[:, LINKS], dtype=np.int64)[rows] - sizes[:, LINKS]
        at = np.arange(many.sum()) + np.repeat(starts - np.cumsum(many, dtype=np.int64) + many, many)
        return Aligned(self.whole[rows], sizes, text, self.links[at])


def one_after_another(parts: list[Aligned]) -> Aligned:
    whole, sizes, text, links = zip(*parts, strict=True)
    return Aligned(np.concatenate(whole), np.concatenate(sizes), "".join(text), np.concatenate(links))


NO_UNITS = Aligned(np.zeros(0, dtype=bool), np.zeros((0, 5), dtype=np.int32), "", np.zeros(0, dtype=np.int64))


def joined_units(units: list[str]) -> list[list[str]]:
    """Units in runs that both tokenizers cut as they would cut them one by one."""
    runs, run = [], []
    for unit in units:
        run.append(unit)
        # White space at the end of a unit would join that of the next.
        if len(run) == RUN or unit[-1] in WHITE:
            runs.append(run)
            run = []
    runs.append(run)
    return [some for r in runs if r for some in ([r] if PLAIN.fullmatch("".join(r)) else [[u] for u in r])]


class Pair:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, bpe_path: str, piece_path: str):
        # Spark spreads the work; a worker's tokenizer keeps to its own core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(bpe_path)
        self.first.encode_special_tokens = True
        byte = {c: b for b, c in enumerate(byte_letters())}
        self.a_bytes = [b""] * self.first.get_vocab_size()
        for token, at in self.first.get_vocab().items():
            self.a_bytes[at] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.b_bytes = [self._piece(i) for i in range(self.second.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        self.space = self.second.piece_to_id(SPACE_MARK)
        # A piece with white space after anything else could cross the start of a unit.
        crosses = re.compile(f"[^{WHITE}{SPACE_MARK}]([{WHITE}{SPACE_MARK}])")
        real = [self.second.id_to_piece(i) for i in range(len(self.b_bytes)) if not self.second.is_byte(i)]
        self.crossing = {c for piece in real for c in crosses.findall(piece)}
        self.known: dict[str, int] = {}  # places in `aligned`, rising
        self.aligned, self.again = NO_UNITS, np.zeros(0, dtype=bool)  # again: has come again
        self.held = 0
        # What the text of groups says for a token, by what follows it.
        self.a_text = np.array([[f"{i},", f"{i}|"] for i in range(len(self.a_bytes))], dtype=object)
        self.b_text = np.array([[f"{i},", f"{i};"] for i in range(len(self.b_bytes))], dtype=object)

    def _piece(self, at: int) -> bytes:
        piece = self.second.id_to_piece(at)
        if self.second.is_byte(at):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    def units(self, text: str) -> list[str]:
        """A text with a space before it, cut where both tokenizers start anew."""
        spaced = " " + text
        whole = SPACE_MARK in self.crossing or any(c in text for c in self.crossing) or not PLAIN.fullmatch(text)
        return [spaced] if whole else UNIT.findall(spaced)

    def look_up(self, units: list[str]) -> Aligned:
        """The alignments of some different units, new ones learned together."""
        at = np.array([self.known.get(u, -1) for u in units], dtype=np.int64)
        fresh = at < 0
        self.again[at[~fresh]] = True
        new = [units[i] for i in np.flatnonzero(fresh).tolist()]
        parts, start = [self.aligned], 0
        while start < len(new):
            end, held = start, 0
            while end < len(new) and (end == start or held + len(new[end]) <= CALL_BYTES):
                held += len(new[end])
                end += 1
            parts.append(self.align(new[start:end]))
            start = end
        at[fresh] = len(self.known) + np.arange(len(new))
        together = one_after_another(parts)
        found = together.chosen(at)
        self._remember(new, together)
        return found

    def _remember(self, new: list[str], together: Aligned) -> None:
        """Takes in new units, `together` behind the known ones; beyond REMEMBERED only known ones that came again stay."""
        short = [len(u) <= SHORT for u in new]
        sizes = together.sizes[len(self.known):][np.array(short, dtype=bool)]
        # A unit's string, place and sizes with Python's own share, the text and the links.
        held = self.held + sum(200 + 2 * len(u) for u in new if len(u) <= SHORT) + int(sizes[:, CHARS].sum() + 8 * sizes[:, LINKS].sum())
        if held <= REMEMBERED:
            stay = np.concatenate([np.ones(len(self.known), dtype=bool), np.array(short, dtype=bool)])
            self.aligned = together if stay.all() else together.chosen(np.flatnonzero(stay))
            self.known.update({u: i for i, u in enumerate((u for u in new if len(u) <= SHORT), len(self.known))})
            self.again = np.concatenate([self.again, np.zeros(len(self.known) - len(self.again), dtype=bool)])
            self.held = held
            return
        kept = [u for u, again in zip(self.known, self.again.tolist(), strict=True) if again]
        aligned = self.aligned.chosen(np.flatnonzero(self.again))
        held = sum(200 + 2 * len(u) for u in kept) + len(aligned.text) + aligned.links.nbytes
        if held > REMEMBERED // 2:
            kept, aligned, held = [], NO_UNITS, 0
        self.known, self.aligned, self.held = {u: i for i, u in enumerate(kept)}, aligned, held
        self.again = np.zeros(len(kept), dtype=bool)

    def align(self, units: list[str]) -> Aligned:
        """Encodes and aligns some units."""
        runs = joined_units(units)
        a_all, b_all = self._encode(["".join(r) for r in runs])
        whole = np.ones(len(units), dtype=bool)
        if not self._give_back(runs, a_all, b_all):
            whole, a_all, b_all = self._one_by_one(runs, a_all, b_all)
        a, b = (np.array(list(chain.from_iterable(ids)), dtype=np.int64) for ids in (a_all, b_all))
        # Units one after another: both sides end together at the end of each, so no group or link crosses it.
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        unit_ends = np.cumsum(np.array([len(u.encode()) for u in units], dtype=np.int64) * whole)
        a_stop, b_stop = np.searchsorted(a_ends, unit_ends, "right"), np.searchsorted(b_ends, unit_ends, "right")
        a_last, b_last = components(a_ends, b_ends)
        place = np.concatenate([a_ends, b_ends])  # groups by where they end, so in order
        a_group, b_group = (place[x] if len(x) else x for x in (a_last, b_last))
        link_a, link_b = overlaps(a_ends, b_ends)
        said = group_pieces(self, a, b, a_group, b_group)
        sizes = np.empty((len(units), 5), dtype=np.int32)
        sizes[:, A], sizes[:, B] = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
        sizes[:, GROUPS] = per_part(np.diff(a_group, prepend=-1) != 0, a_stop)
        sizes[:, LINKS] = np.diff(np.searchsorted(link_a, a_stop), prepend=0)
        sizes[:, CHARS] = per_part([len(w) for w in said], a_stop + b_stop)
        return Aligned(whole, sizes, "".join(said), a[link_a] * len(self.b_bytes) + b[link_b])

    def _encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B of texts that have their own space before them."""
        a_all = [e.ids for e in self.first.encode_batch_fast(texts, add_special_tokens=False)]
        # B puts a space before what it is given: the text's own, or one that is taken off again.
        b_all = self.second.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        for i, text in enumerate(texts):
            if text == " ":
                b_all[i] = [self.space]  # nothing is put before nothing
            elif text[0] != " ":
                b_all[i] = b_all[i][1:] if b_all[i][:1] == [self.space] else []
        return a_all, b_all

    def _one_by_one(
        self, runs: list[list[str]], a_all: list[list[int]], b_all: list[list[int]]
    ) -> tuple[np.ndarray, list[list[int]], list[list[int]]]:
        """Which units give their bytes back, and their ids: those of a run that does not, encoded by themselves."""
        fine = [self._give_back([r], [a], [b]) for r, a, b in zip(runs, a_all, b_all, strict=True)]
        alone = [u for r, ok in zip(runs, fine, strict=True) if not ok for u in r]
        again = zip(alone, *self._encode(alone), strict=True)
        whole, a_out, b_out = [], [], []
        for run, ok, a, b in zip(runs, fine, a_all, b_all, strict=True):
            if ok:
                whole += [True] * len(run)
                a_out.append(a)
                b_out.append(b)
                continue
            for unit, own_a, own_b in islice(again, len(run)):
                whole.append(self._give_back([[unit]], [own_a], [own_b]))
                if whole[-1]:
                    a_out.append(own_a)
                    b_out.append(own_b)
        return np.array(whole, dtype=bool), a_out, b_out

    def _give_back(self, runs: list[list[str]], a_all: list[list[int]], b_all: list[list[int]]) -> bool:
        """Whether the tokens of every run give its bytes back and end where its units do, on both sides."""
        raw = [u.encode() for r in runs for u in r]
        together, stops = b"".join(raw), np.cumsum([len(r) for r in raw])
        run_stops = stops[np.cumsum([len(r) for r in runs]) - 1]
        for all_ids, own, own_sizes in ((a_all, self.a_bytes, self.a_sizes), (b_all, self.b_bytes, self.b_sizes)):
            ids = list(chain.from_iterable(all_ids))
            ends = np.concatenate([[0], np.cumsum(own_sizes[np.array(ids, dtype=np.int64)])])
            at = np.minimum(np.searchsorted(ends, stops), len(ids))
            given = ends[np.cumsum([len(x) for x in all_ids])]
            if not np.array_equal(ends[at], stops) or not np.array_equal(given, run_stops) or b"".join([own[t] for t in ids]) != together:
                return False
        return True


@lru_cache(maxsize=1)
def tokenizers(bpe_path: str, piece_path: str) -> Pair:
    """One pair per worker process."""
    return Pair(bpe_path, piece_path)


def per_part(values: Any, stops: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts that end at the given places."""
    return np.diff(np.concatenate([[0], np.cumsum(np.asarray(values, dtype=np.int64))])[stops], prepend=0)


def components(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every A and every B token the place, among A then B tokens, of its group's last token.

    `a_ends` and `b_ends` are the rising byte offsets at which tokens end; both
    start at 0 and end alike. Where both sides end at one byte the A token is the
    last of the group.
    """
    n = len(a_ends)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    # The token of the other side that holds a token's last byte reaches farthest, or the token itself does.
    b_at_a = np.searchsorted(b_ends, a_ends)
    a_at_b = np.searchsorted(a_ends, b_ends)
    point = np.concatenate([
        np.where(b_ends[b_at_a] > a_ends, n + b_at_a, np.arange(n)),
        a_at_b,
    ])
    while True:
        farther = point[point]
        if np.array_equal(farther, point):
            return point[:n], point[n:]
        point = farther


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all A and B tokens whose byte ranges meet, by A token, then B token."""
    a_starts = np.concatenate([[0], a_ends[:-1]]) if len(a_ends) else a_ends
    low = np.searchsorted(b_ends, a_starts, side="right")
    high = np.searchsorted(b_ends, a_ends)  # the B token that holds A's last byte
    many = high - low + 1
    a = np.repeat(np.arange(len(a_ends)), many)
    b = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    return a, b


def group_pieces(
    pair: Pair, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray
) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` token by token: ids of each group in order; groups are named by rising numbers."""
    last_a, last_b = np.ones(len(a), dtype=int), np.ones(len(b), dtype=int)
    last_a[:-1], last_b[:-1] = a_group[1:] != a_group[:-1], b_group[1:] != b_group[:-1]
    said = np.concatenate([pair.a_text[a, last_a], pair.b_text[b, last_b]])
    side = np.concatenate([np.zeros(len(a), dtype=int), np.ones(len(b), dtype=int)])
    order = np.lexsort((side, np.concatenate([a_group, b_group])))
    return said[order].tolist()


def _packed(numbers: np.ndarray, kind: str) -> bytes:
    return zlib.compress(np.asarray(numbers).astype(kind).tobytes(), 1)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=kind)


def align_block(pair: Pair, texts: list[bytes]) -> dict[str, Any]:
    """Figures, units, links and id pairs of a block of texts."""
    cut: list[list[str]] = []
    for raw in texts:
        try:
            cut.append(pair.units(raw.decode()) if raw else [])
        except UnicodeDecodeError:
            cut.append([])
    number = {u: i for i, u in enumerate(dict.fromkeys(chain.from_iterable(cut)))}
    aligned = pair.look_up(list(number))
    broken = set(np.flatnonzero(~aligned.whole).tolist())
    said, digests, places = aligned.texts(), [], []
    for units in cut:
        at = [number[u] for u in units]
        if broken and not broken.isdisjoint(at):
            at = []
        places.append(at)
        digests.append(hashlib.sha256("".join([said[i] for i in at])[:-1].encode()).hexdigest() if at else "")
    units = np.array(list(chain.from_iterable(places)), dtype=np.int64)
    unit_stops = np.cumsum([len(at) for at in places])
    n_links = aligned.sizes[:, LINKS].astype(np.int64)
    pairs, at = np.unique(aligned.links, return_inverse=True)
    # Units of texts that do not count leave pairs without links.
    times = np.repeat(np.bincount(units, minlength=len(number)), n_links)
    n = np.bincount(at, weights=times, minlength=len(pairs)).astype(np.int64)

    def per_text(of_units: np.ndarray) -> np.ndarray:
        return per_part(of_units[units], unit_stops)

    return {
        **{name: per_text(aligned.sizes[:, of]) for name, of in (("n_a", A), ("n_b", B), ("n_groups", GROUPS), ("n_links", LINKS))},
        "groups_sha256": digests,
        "unit_stops": _packed(unit_stops, "<i8"), "units": _packed(units, "<i4"),
        "link_stops": _packed(np.cumsum(n_links), "<i8"), "links": _packed(at, "<i4"),
        "a": (pairs // len(pair.b_bytes)).astype(np.int32), "b": (pairs % len(pair.b_bytes)).astype(np.int32), "n": n,
    }


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts, `most` bytes of text at a time."""
    ids: list = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        for at in range(batch.num_rows):
            text = batch.column(1)[at].as_py() or b""
            if ids and held + len(text) > most:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(batch.column(0)[at].as_py())
            texts.append(text)
            held += len(text)
    if ids:
        yield ids, texts


def align(
    docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per document."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(bpe_path, piece_path)
        # Numbers of blocks count within a table that is written once, so they name what was written.
        number = TaskContext.get().partitionId() << 32
        # No cycles are made; walking all remembered units for some would cost a fifth of the time.
        gc.disable()
        try:
            for ids, texts in _blocks(batches, block_bytes):
                found = {"ids": ids} | align_block(pair, texts)
                columns = [pa.array([number], pa.int64()), *[pa.array([found[name]], kind) for name, kind in PARTS]]
                yield pa.RecordBatch.from_arrays(columns, schema=BLOCK_ARROW)
                number += 1
        finally:
            gc.enable()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("body"))
    blocks = saved(rows.mapInArrow(encode, BLOCK), "aligned-blocks")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("at", "p")).select(
        "block", "at", "p.a", "p.b", "p.n"
    )
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count")).where("count > 0")
    # A window holds the A ids that meet one B id: no more than A has.
    best = counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))
    # Written, so that AQE can split a pair that stands in most blocks.
    known = saved(best, "aligned-counts")
    told = pairs.drop("n").join(known, ["a", "b"], "left").groupBy("block").agg(
        F.sort_array(
            F.collect_list(F.struct("at", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("best", F.lit(False)).alias("best")))
        ).alias("told")
    )
    figures = blocks.drop("a", "b", "n").join(told, "block", "left").select(
        *[c for c in blocks.columns if c not in ("block", "a", "b", "n")],
        F.col("told.count").alias("count"), F.col("told.best").alias("best"),
    )
    return figures.mapInArrow(_add_up, FIGURES).withColumnRenamed("id", id_col)


FIGURES = (
    "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each document looked up in what is known of the block's pairs."""
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(batch.schema.get_field_index(name))[row]  # noqa: B023, E731
            known = get("count").values
            count = known.to_numpy() if known is not None else np.zeros(0, dtype=np.int64)
            best = get("best").values.to_numpy(zero_copy_only=False) if known is not None else np.zeros(0, dtype=bool)
            links, link_stops = _unpacked(get("links").as_py(), "<i4"), _unpacked(get("link_stops").as_py(), "<i8")
            units, unit_stops = _unpacked(get("units").as_py(), "<i4"), _unpacked(get("unit_stops").as_py(), "<i8")

            n_best, count_sum = (per_part(per_part(x[links], link_stops)[units], unit_stops) for x in (best, count))
            plain = [get(name).values for name in ("ids", "n_a", "n_b", "n_groups", "n_links")]
            columns = [*plain, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), get("groups_sha256").values]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in FIGURES.split(", ")])
