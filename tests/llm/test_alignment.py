"""Token alignment against two pointers walking over the bytes."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from oracle import connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillmark.llm import alignment
from rillmark.llm.byte_bpe import byte_letters
from rillmark.llm.queries import QUERIES

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NONE = (0, 0, 0, 0, 0, 0, "")


def walked(rows):
    """Per row: figures as the operator returns them, from groups found token by token."""
    one, two = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    one.encode_special_tokens = True
    byte = {c: b for b, c in enumerate(byte_letters())}
    found, counts = [], Counter()
    for text in rows:
        whole = b" " + (text or "").encode()
        a = one.encode(whole.decode(), add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        left = [bytes(byte[c] for c in one.id_to_token(i)) for i in a]
        right = [bytes([int(two.id_to_piece(i)[3:-1], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(left) != whole or b"".join(right) != whole:
            found.append(None)
            continue
        groups, links, i, j = [([a[0]], [b[0]])], [], 0, 0
        at, there = len(left[0]), len(right[0])
        while True:
            links.append((a[i], b[j]))
            step_a, step_b = at <= there, there <= at
            if step_a and step_b:
                if i + 1 == len(a):
                    break
                groups.append(([], []))
            if step_a:
                i += 1
                at += len(left[i])
                groups[-1][0].append(a[i])
            if step_b:
                j += 1
                there += len(right[j])
                groups[-1][1].append(b[j])
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for f in found:
        if f is None:
            out.append(NONE)
            continue
        n_a, n_b, groups, links = f
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(counts[x] == highest[x[1]] for x in links)
        out.append((n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_ends_of_groups_by_pointer_doubling():
    rnd = random.Random(2)
    for n in (1, 2, 7, 60, 500):
        a = np.array(sorted({*rnd.sample(range(1, 3 * n + 1), n), 3 * n + 1}))
        b = np.array(sorted({*rnd.sample(range(1, 3 * n + 1), n), 3 * n + 1}))
        last_a, last_b = alignment.components(a, b)
        common = np.intersect1d(a, b)
        assert (a[last_a] == common[np.searchsorted(common, a)]).all()
        assert (a[last_b] == common[np.searchsorted(common, b)]).all()  # the A token is the last of a group
        x, y = alignment.overlaps(a, b)
        starts = lambda ends: np.concatenate([[0], ends[:-1]])
        plain = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts(a)[i] < b[j] and starts(b)[j] < a[i]]
        assert list(zip(x.tolist(), y.tolist(), strict=True)) == plain


def test_a_chain_through_a_whole_text():
    # Ends never meet before the last byte, so one group holds all tokens.
    a, b = np.array([*range(2, 2000, 2), 2001]), np.array([*range(1, 2000, 2), 2001])
    last_a, last_b = alignment.components(a, b)
    assert set(last_a) == set(last_b) == {len(a) - 1}


ODD = [
    None, "", " ", "\n\n", "  two  spaces ", "tabs\tand\r\nlines", "<|endoftext|> and <s> </s> <unk> <0x41>", "été ▁ naïve 日本語 🎉🎉",
    "\x00\x01 control", "word " * 30_000, "a" * 20_000, "é    ", "same text", "same text", "don't  we'll",
]


@pytest.mark.parametrize("block", [1, 40, alignment.BLOCK_BYTES])
def test_odd_texts(spark, block):
    rows = [(i, t, 3, "k", 1) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int, a string, n int").repartition(3)
    out = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs, BPE, PIECES, block_bytes=block).select(*ORDER).collect()}
    assert [out[i] for i in range(len(ODD))] == walked(ODD)


def test_units_change_nothing(spark):
    """Runs of all kinds of white space, signs that engines read differently, and pieces that end in white space."""
    rnd = random.Random(9)
    letters = [" ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x0c", "a", "the", "don't", "'s", "é", "ß", "1", "23", ",", ");", "{", "-", "_"]
    odd = ["\r", "\x1c", "\x85", "\xa0", "\xad", "\u2003", "\u3000", "日", "़", "🎉", "<s>", "▁", "\ufeff", "ﬁ", "²", "ǅ"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 40))) for _ in range(200)]
    texts += ["".join(rnd.choice(letters + odd) for _ in range(rnd.randrange(1, 40))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    out = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs, BPE, PIECES, block_bytes=500).select(*ORDER).collect()}
    assert [out[i] for i in range(len(texts))] == walked(texts)


def test_remembered_units_are_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 20_000)
    pair = alignment.Pair(BPE, PIECES)
    texts = [f"word{i} {'x' * 500}{i} again".encode() for i in range(200)]
    whole = alignment.align_block(pair, texts)
    for i in range(0, 200, 20):
        alignment.align_block(pair, texts[i : i + 20])
        assert pair.held <= 40_000 and all(len(u) <= alignment.SHORT for u in pair.known)
    assert whole["groups_sha256"] == alignment.align_block(pair, texts)["groups_sha256"]


ORDER = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_repeated_ids_empty_tables_and_broken_bytes(spark):
    docs = spark.createDataFrame([(1, "one"), (1, "two"), (None, "one"), (None, None)], "doc_id long, text string")
    out = sorted((tuple(r) for r in alignment.align(docs, BPE, PIECES).select(*ORDER).collect()), key=repr)
    want = sorted(((i, *w) for i, w in zip((1, 1, None, None), walked(["one", "two", "one", None]), strict=True)), key=repr)
    assert out == want
    assert alignment.align(docs.limit(0), BPE, PIECES).count() == 0
    broken = docs.limit(1).select("doc_id", F.unhex(F.lit("61FF62")).cast("string").alias("text"))
    assert [tuple(r)[1:] for r in alignment.align(broken, BPE, PIECES).select(*ORDER).collect()] == [NONE]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_the_query_over_documents(spark):
    docs = connect(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall()
    out = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_alignment"].run(spark, SF_DIR).select(*ORDER).collect()}
    assert len(out) == len(docs)
    assert [out[i] for i, _ in docs] == walked([t for _, t in docs])


class Counted:
    """The first tokenizer, with the texts that it was given."""

    def __init__(self, real):
        self.real, self.texts = real, []

    def encode_batch_fast(self, texts, **how):
        self.texts += texts
        return self.real.encode_batch_fast(texts, **how)


def test_new_units_are_encoded_in_runs_and_those_that_come_again_stay(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 80_000)
    pair = alignment.Pair(BPE, PIECES)
    pair.first = counted = Counted(pair.first)
    often = [f"often{i}" for i in range(50)]
    new = units = 0
    for block in range(40):
        own = [f"own{block}x{i}" for i in range(50)]
        alignment.align_block(pair, [" ".join([*often, *own]).encode()])
        units += len(own)
        new += sum(text.count(" ") for text in counted.texts)
        assert all(text.count(" ") > 10 for text in counted.texts)
        counted.texts.clear()
    assert new == units + len(often) and pair.held <= 80_000


def test_runs_give_what_units_give_one_by_one(monkeypatch):
    rnd = random.Random(12)
    words = ["the", "don't", "été", "1st", "²", "x²y", "½", "日本", "\x07", "(a)", "<s>", "--", "naïve", "ĳ"]
    texts = ["".join(rnd.choice([" ", " ", "\n", "  ", "\t"]) + rnd.choice(words) + str(rnd.randrange(50)) for _ in range(30)) for _ in range(300)]
    raw = [t.encode() for t in texts]

    def aligned(run):
        monkeypatch.setattr(alignment, "RUN", run)
        pair = alignment.Pair(BPE, PIECES)
        # As if a token of B did not give its bytes back.
        pair.b_bytes[pair.second.encode(" 37")[-1]] = b"?"
        return {k: list(v) for k, v in alignment.align_block(pair, raw).items()}

    runs = aligned(256)
    assert runs == aligned(1) == aligned(7)
    assert 0 < runs["groups_sha256"].count("") < len(texts)
