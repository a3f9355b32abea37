"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams (1 to 3 letters,
word ends as blanks) by rank. A text gets such a list too; for each of its
n-grams the distance to a profile is how far the ranks lie apart, or the full
length of a profile where it is missing. The language with the smallest sum wins.

Profiles are learned from at most `limit` labelled texts of each language, those
with the smallest hashes of their ids; every text is predicted from all of its
n-grams. Prediction is one pass without a shuffle. Profiles hold `size` n-grams
per language and go to the tasks with the function; with them go the letters seen
in training. Letters never seen there count as one letter of their own. A task
holds the n-grams of PART characters, or of one longer text, at a time.

Defined cases: a null text or one without any letter is `und` with score 0; so is
everything where there is nothing to learn from; equal distances go to the
language that sorts first; a row without id is predicted like any other (and
never learned from).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rillmark.llm import bytes_np as B
from rillmark.llm.common import bounded_broadcast, saved

LIMIT = 1000
AHEAD = 4
SIZE = 300
LONGEST = 3
GAP, OTHER = 1, 2  # symbols of a word end and of an unknown letter; 0 stands for no symbol
UNKNOWN = "und"
PART = 500_000  # characters looked at together
CODE_BITS = 21


class Profiles(NamedTuple):
    """Languages in order; ranks[language, gram]; grams as sorted symbol codes; letters as sorted code points."""

    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    letters: np.ndarray
    bits: int
    size: int


@lru_cache(maxsize=1)
def is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def codes(symbols: np.ndarray, text: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code, text) of every n-gram; blanks stand only at its ends, and never alone."""
    gap = symbols == GAP
    for n in range(1, LONGEST + 1):
        m = len(symbols) - n + 1
        if m <= 0:
            return
        code = np.zeros(m, dtype=np.uint64)
        ok = text[:m] == text[n - 1 :]
        for j in range(n):
            code = (code << np.uint64(bits)) | symbols[j : j + m]
            if 0 < j < n - 1:
                ok &= ~gap[j : j + m]
        ok &= ~gap[:m] if n == 1 else ~(gap[:m] & gap[n - 1 :]) if n == 2 else ok
        yield code[ok], text[:m][ok]


def symbol_rows(texts: list[str], table: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, text number): letters by `table`, runs of anything else as one GAP, also at both ends."""
    low = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    text = np.repeat(np.arange(len(low)), [len(t) for t in low])
    letter = is_letter()[points]
    symbols = np.where(letter, table(points), GAP).astype(np.uint64)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1] | (text[1:] != text[:-1])
    return symbols[keep], text[keep]


def cuts(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of texts: up to PART characters and `most` texts together, or one longer text."""
    i = 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and j - i < most and (j == i or held + len(texts[j]) <= PART):
            held += len(texts[j])
            j += 1
        yield i, j
        i = j


def grams(texts: list[str], table: Callable[[np.ndarray], np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code, count) of the distinct n-grams of each text, in this order."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def count(some: list[str], at: int) -> None:
        symbols, text = symbol_rows(some, table)
        shift = np.uint64(bits * LONGEST)
        if len(some) == 1:
            keys = np.concatenate([c for c, _ in codes(symbols, text, bits)])
        else:
            keys = np.concatenate([c | t.astype(np.uint64) << shift for c, t in codes(symbols, text, bits)])
        keys.sort()
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        own = keys[starts]
        which = np.zeros(len(own), np.int64) if len(some) == 1 else (own >> shift).astype(np.int64)
        code = own if len(some) == 1 else own & ((np.uint64(1) << shift) - np.uint64(1))
        found.append((which + at, code, np.diff([*starts, len(keys)])))

    most = 1 << min(20, 63 - bits * LONGEST) if bits * LONGEST < 63 else 1
    for i, j in cuts(texts, most):
        if j == i + 1 and len(texts[i]) > 4 * PART:
            # A very long text: parts that end between words, then one count.
            first, lo, whole = len(found), 0, texts[i]
            while lo < len(whole):
                hi = min(len(whole), lo + PART)
                while hi < len(whole) and whole[hi - 1].isalpha() and hi - lo < 4 * PART:
                    hi += 1
                count([whole[lo:hi]], i)
                lo = hi
            parts = found[first:]
            del found[first:]
            code, back = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
            total = np.bincount(back, weights=np.concatenate([p[2] for p in parts])).astype(np.int64)
            found.append((np.full(len(code), i), code, total))
        else:
            count(texts[i:j], i)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _top(text: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, ranks) of the `size` most frequent rows of each text; ties in the order given."""
    order = np.argsort((text << 32) - np.minimum(count, (1 << 31) - 1), kind="stable")
    by = text[order]
    starts = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])) if len(by) else np.zeros(0, np.int64)
    rank = np.arange(len(by)) - np.repeat(starts, np.diff([*starts, len(by)]))
    return order[rank < size], rank[rank < size]


def learn(docs: DataFrame, limit: int = LIMIT, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles of the languages of labelled texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("body"))
    rows = rows.where("id IS NOT NULL AND lang IS NOT NULL AND body IS NOT NULL")
    # Only ids with a small hash, about AHEAD times the limit a language, are ranked by it.
    ids = rows.select("id", "lang").withColumn("u", F.pmod(F.xxhash64("id"), F.lit(1 << 40)))
    sizes = saved(ids.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "languages")
    early = ids.join(bounded_broadcast(sizes, sizes.count(), 10_000), "lang")
    early = early.where(F.col("u").cast("double") * F.col("size") <= float(AHEAD * limit * (1 << 40)))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("u", "id"))
    # At most `limit` ids a language.
    chosen = early.withColumn("r", first).where(F.col("r") <= limit).select("id").distinct()
    taken = rows.join(F.broadcast(chosen), "id", "left_semi").select("lang", "body")
    arrow = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for lang, part in frame.groupby("lang"):
                bodies = list(part.body)
                for i, j in cuts(bodies, len(bodies)):
                    # Code points themselves are the symbols here.
                    _, code, n = grams(bodies[i:j], lambda points: points, CODE_BITS)
                    found = pd.Series(n).groupby(code).sum()
                    columns = [pa.array([lang] * len(found)), pa.array(found.index.to_numpy().view(np.int64)), pa.array(found.to_numpy())]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    counts = taken.mapInArrow(B.tidy(over), "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code")))
    single = F.col("code") < (1 << CODE_BITS)
    kept = ranked.where((F.col("r") <= size) | single).select("lang", "code", "r").toPandas()
    points = np.unique(kept.code[kept.code < (1 << CODE_BITS)].to_numpy())
    return profiles(kept[kept.r <= size], points, size)


def profiles(kept: pd.DataFrame, points: np.ndarray, size: int) -> Profiles:
    """Profiles of rows (lang, code of code points, rank from 1) over the letters `points`."""
    bits = int(len(points) + OTHER + 1).bit_length()
    langs = sorted(kept.lang.unique())

    def recoded(code: int) -> int:
        parts = []
        while code:
            parts.append(code & (1 << CODE_BITS) - 1)
            code >>= CODE_BITS
        out = 0
        for p in reversed(parts):
            out = out << bits | (GAP if p == GAP else int(np.searchsorted(points, p)) + OTHER + 1)
        return out

    new = np.array([recoded(int(c)) for c in kept.code], dtype=np.uint64)
    all_grams = np.unique(new)
    ranks = np.full((len(langs), len(all_grams)), -1, dtype=np.int64)
    for lang, code, r in zip(kept.lang, new, kept.r, strict=True):
        ranks[langs.index(lang), np.searchsorted(all_grams, code)] = r - 1
    return Profiles(langs, all_grams, ranks, points.astype(np.uint32), bits, size)


def predict_texts(texts: list[str], known: Profiles) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text; the score is 1 minus the mean distance as a share of the largest."""
    table = np.full(0x110000, OTHER, dtype=np.uint32) if len(known.letters) else None
    if table is None or not known.langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    table[known.letters] = np.arange(len(known.letters)) + OTHER + 1
    langs, scores = [], [np.zeros(0)]
    # Of each run only the names and scores are kept, however many texts come together.
    for i, j in cuts(texts, len(texts)):
        some, score = _predict_run(texts[i:j], known, table)
        langs += some
        scores.append(score)
    return langs, np.concatenate(scores)


def _predict_run(texts: list[str], known: Profiles, table: np.ndarray) -> tuple[list[str], np.ndarray]:
    text, code, count = grams(texts, lambda points: table[points], known.bits)
    top, rank = _top(text, count, known.size)
    text, code = text[top], code[top]
    at = np.minimum(np.searchsorted(known.grams, code), len(known.grams) - 1)
    hit = known.grams[at] == code
    n = np.bincount(text, minlength=len(texts))
    far = np.empty((len(known.langs), len(texts)))
    for i, ranks in enumerate(known.ranks):
        there = ranks[at]
        out = np.where(hit & (there >= 0), np.abs(there - rank), known.size)
        far[i] = np.bincount(text, weights=out, minlength=len(texts))
    best = far.argmin(axis=0)
    share = far[best, np.arange(len(texts))] / np.maximum(n * known.size, 1)
    lettered = n > 0
    return [known.langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)], np.where(lettered, 1 - share, 0.0)


def predict(docs: DataFrame, known: Profiles, text_col: str = "text") -> DataFrame:
    """The rows with lang_pred and score; all columns of `docs` stay, ones of these names are replaced."""
    kept = docs.drop("lang_pred", "score")

    @F.pandas_udf("lang_pred string, score double")
    def guess(bodies: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for body in bodies:
            lang, score = predict_texts([t or "" for t in body], known)
            yield pd.DataFrame({"lang_pred": lang, "score": score})
        B.give_back()

    both = kept.select(F.struct(*(F.col(f"`{c}`") for c in kept.columns)).alias("row"), guess(F.col(text_col)).alias("guess"))
    return both.select("row.*", "guess.lang_pred", "guess.score")


def learnable(id_col: str = "doc_id"):
    """Rows that may be learned from: three in four, by a checksum of the id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2
