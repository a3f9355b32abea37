"""Byte-level BPE by a sentencepiece model serialised from a rank file.

The rank file lists byte strings by merge rank. Each becomes a piece of a
sentencepiece BPE model: its bytes are mapped to 256 printable characters, its
score is the negative rank, and normalisation is the identity. Scores that fall
with the rank make sentencepiece merge what the ranks merge first, so encoding a
mapped pre-token gives the rank file's ids; decoding maps pieces back to bytes.

A vocabulary may hold tokens that merges never reach; an encoder that looks
whole pre-tokens up first still uses them. They are found once per worker by
encoding the vocabulary with itself, and looked up before sentencepiece is asked.

Documents are encoded in the tasks that read them; nothing is shuffled. Ids of
pre-tokens and words seen before are kept in two tables of at most `CACHE` entries
or one text's words per worker.

Defined cases: a null text counts as empty and has no tokens; every row gives a
row; the ids of a text of any length are kept whole.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rillmark.llm import bytes_np as B

CACHE = 500_000
ROWS = 512  # texts encoded together
# White space as tokenizers with this pattern take it: Unicode's White_Space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it is printable, else one above 255."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in the order of their ranks, which must be 0, 1, 2 and so on."""
    with open(path, "rb") as lines:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks have gaps")
    return [token for _, token in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: an integer, a 32-bit float or bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def model_bytes(tokens: list[bytes]) -> bytes:
    """The sentencepiece model: piece i is token i; the unknown piece comes after the last."""
    letter = byte_letters()
    pieces = [
        _field(1, _field(1, "".join(letter[b] for b in token).encode()) + _field(2, float(-rank)) + _field(3, 1))
        for rank, token in enumerate(tokens)
    ]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    none = -1
    trainer = (
        _field(3, 2)  # model type BPE
        + _field(4, len(pieces)) + _field(24, 0)  # size; white space is no suffix
        + _field(40, len(tokens)) + _field(41, none) + _field(42, none) + _field(43, none)  # unk, bos, eos, pad
    )
    # Identity: no prefix space, no space removed, no space escaped.
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class Tokenizer:
    """Encodes texts to ids and back; `pattern` cuts texts into pre-tokens."""

    def __init__(self, rank_path: str, pattern: str):
        import sentencepiece

        self.tokens = read_ranks(rank_path)
        letter = byte_letters()
        self.table = {b: letter[b] for b in range(256)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        self.cut = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        mapped = [self._mapped(t) for t in self.tokens]
        reached = self.model.encode(mapped, num_threads=1)
        self.whole = {t: i for i, (t, ids) in enumerate(zip(self.tokens, reached, strict=True)) if ids != [i]}
        self.known: dict[str, bytes] = {}  # pre-token -> ids
        self.spaced: dict[str, bytes] = {}  # word -> ids of the word with a space before it
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.joined = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)

    def forget(self) -> None:
        """Drops what it has seen: a worker waits on after its task, beside the JVM and other stages."""
        self.known, self.spaced = {}, {}

    def _mapped(self, raw: bytes) -> str:
        # Latin-1 turns each byte into the character of that number.
        return raw.decode("latin-1").translate(self.table)

    def _learn(self, new: list[str]) -> None:
        raw = [t.encode() for t in new]
        for text, data, ids in zip(new, raw, self.model.encode([self._mapped(r) for r in raw], num_threads=1), strict=True):
            whole = self.whole.get(data)
            self.known[text] = np.array(ids if whole is None else [whole], dtype="<u4").tobytes()

    def _pieces(self, text: str) -> bytes:
        """Ids by cutting the whole text into pre-tokens."""
        parts = self.cut.findall(text)
        self._know(parts)
        return b"".join([self.known[p] for p in parts])

    def _know(self, parts: Iterable[str]) -> None:
        known = self.known
        if new := {p for p in parts if p not in known}:
            if len(known) + len(new) > CACHE:
                known.clear()
                new = set(parts)
            self._learn(list(new))

    def _space(self, texts: list[list[str]]) -> None:
        """Learns the words of these texts, all at once: a call of sentencepiece costs more than a word."""
        spaced = self.spaced
        new = {w for words in texts for w in words if w not in spaced}
        if len(spaced) + len(new) > CACHE:
            spaced.clear()
            new = {w for words in texts for w in words}
        cut = {w: self.cut.findall(" " + w) for w in new if w and not w[0].isspace() and not w[-1].isspace()}
        self._know([p for parts in cut.values() for p in parts])
        known = self.known
        for w, parts in cut.items():
            spaced[w] = b"".join([known[p] for p in parts])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.

        A single space between other characters always starts a pre-token, so
        words behind such spaces are encoded on their own and remembered. A text
        with white space beside a space is cut as a whole.
        """
        split = [t.split(" ") for t in texts]
        self._space([words[1:] for words in split])
        spaced, out = self.spaced, []
        for text, (first, *words) in zip(texts, split, strict=True):
            try:
                ids = [spaced[w] for w in words]
            except KeyError:
                out.append(self._pieces(text))
            else:
                odd = words and first[-1:].isspace()
                out.append(self._pieces(text) if odd else self._pieces(first) + b"".join(ids))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        at = np.frombuffer(ids, dtype="<u4")
        if not len(at):
            return b""
        sizes = self.lengths[at]
        ends = np.cumsum(sizes)
        # For every byte of the result its place in the joined vocabulary.
        step = np.ones(ends[-1], dtype=np.int64)
        step[0] = self.starts[at[0]]
        step[ends[:-1]] = self.starts[at[1:]] - (self.starts[at[:-1]] + sizes[:-1]) + 1
        return self.joined[np.cumsum(step)].tobytes()


@lru_cache(maxsize=2)
def tokenizer(rank_path: str, pattern: str) -> Tokenizer:
    """One per worker process, built from the rank file that every worker has."""
    return Tokenizer(rank_path, pattern)


def _with_texts(
    docs: DataFrame, id_col: str, text_col: str, schema: str, arrow: pa.Schema,
    model: Callable[[], Tokenizer], each: Callable[[Tokenizer, list[str]], list[tuple]],
) -> DataFrame:
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at, ROWS)
                    rows = each(model(), [t or "" for t in batch.column(1).to_pylist()])
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=arrow)
        finally:
            model().forget()

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("body"))
    return rows.mapInArrow(B.tidy(over), schema).withColumnRenamed("id", id_col)


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array of ids): every whole text."""
    arrow = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def ids(model: Tokenizer, texts: list[str]) -> list[tuple]:
        return [(np.frombuffer(x, dtype="<i4"),) for x in model.encode_all(texts)]

    return _with_texts(docs, id_col, text_col, "id long, ids array<int>", arrow, lambda: tokenizer(rank_path, pattern), ids)


def decode(encoded: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id, data (bytes): what the ids stand for; null ids give no bytes."""
    arrow = pa.schema([("id", pa.int64()), ("data", pa.binary())])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [tokenizer(rank_path, pattern).decode(np.array(x.as_py() or [], dtype="<u4").tobytes()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], schema=arrow)

    rows = encoded.select(encoded[id_col].cast("long").alias("id"), "ids")
    return rows.mapInArrow(B.tidy(over), "id long, data binary").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, ids never leaving the task."""
    arrow = pa.schema(
        [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def both(model: Tokenizer, texts: list[str]) -> list[tuple]:
        return [
            (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(model.decode(ids)).hexdigest())
            for ids in model.encode_all(texts)
        ]

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _with_texts(docs, id_col, text_col, schema, arrow, lambda: tokenizer(rank_path, pattern), both)
