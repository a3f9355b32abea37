"""WARC, suffix dedup, Jaccard join, language ID, BPE and chats on small tables."""

import base64
import hashlib
import random

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from rillmark.llm import byte_bpe, chat_tools, components, jaccard_join, language_id, suffix_dedup, warc
from rillmark.llm import bytes_np as B

DOCS = "doc_id long, text string, id int, key string, n int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", 2) for i, t in rows], DOCS).repartition(3)


def test_warc_round_trip(spark, folder):
    big = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 60
    pages = [(1, "http://a", big), (2, None, big), (3, "http://c\r\nx: y", big + "."), (4, "u", None), (5, "u", ""), (6, "u", "small"), (7, "u", "small"), (8, "u", big), (None, "u", big), (9, "u", "x" * 400_000)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    warc.write_archives(df, f"{folder}/w")
    out = {r.page_id: r for r in warc.link(warc.read_archives(spark, f"{folder}/w")).collect()}
    assert len(out) == len(pages) and all(r.intact for r in out.values())
    for i, _, html in pages:
        data = (html or "").encode()
        again = html == big and i != 8
        assert (out[i].payload_bytes, out[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (out[i].record_type, out[i].refers_to) == (("revisit", 8) if again else ("response", None))


def test_warc_without_pages(spark, folder):
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"{folder}/w")
    assert warc.link(warc.read_archives(spark, f"{folder}/w")).count() == 0


def test_warc_cut_off_is_seen():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))


def spans_rows():
    rnd = random.Random(5)
    voc = ["the", "of", "and", "été", "in", "x", "tion", "over", "aa", "a"]
    base = [" ".join(rnd.choice(voc) for _ in range(rnd.randint(1, 120))) for _ in range(12)]
    rows = []
    for i in range(120):
        t = rnd.choice(base)
        a, b = sorted(rnd.randrange(len(t) + 1) for _ in range(2))
        u = t[a:b] + rnd.choice(["", "zz", " ".join(rnd.choice(voc) for _ in range(8))]) + rnd.choice(base)[: rnd.randint(0, 90)]
        rows.append((i, rnd.choice([u, u, t, u + u])))
    return rows + [(900, None), (901, ""), (902, "a" * 49), (903, "a" * 50), (904, "a" * 500), (905, "ab" * 400), (906, "b" + "ab" * 300)]


@pytest.mark.parametrize("ways", [{}, {"heavy_least": 3, "heavy_share": 200, "part": 700}, {"part": 300}])
def test_suffix_dedup_against_brute_force(spark, ways):
    rows = spans_rows()
    out = suffix_dedup.dedup(docs_of(spark, rows), **ways).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == brute.covered(rows)
    assert all(brute.sha(bytes(r.text)) == r.kept_sha256 for r in out)


def test_suffix_dedup_null_and_repeated_ids(spark):
    t = "some words that are long enough to count as a passage of fifty bytes"
    rows = [(None, t), (1, t + "1"), (1, t + "2"), (2, t + "3")]
    got = sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup.dedup(docs_of(spark, rows)).collect())
    assert got == [(0, 0), (1, 0), (1, 0), (2, len(t))]
    assert suffix_dedup.dedup(docs_of(spark, [])).count() == 0


def test_factors_follow_the_suffix_order():
    rnd = np.random.default_rng(1)
    rows = rnd.integers(97, 99, (400, suffix_dedup.SPAN)).astype(np.uint8)
    rows[:, 5:] = 97
    key, doc = rnd.integers(0, 3, 400).astype(np.uint64), rnd.integers(0, 60, 400)
    got = suffix_dedup.factors(key, doc, rows)
    want = [any(key[j] == key[i] and doc[j] < doc[i] and (rows[j] == rows[i]).all() for j in range(400)) for i in range(400)]
    assert got.tolist() == want


def near_rows():
    rnd = random.Random(3)
    voc = [f"w{i}" for i in range(400)]
    rows = []
    for size in [1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 15, 20, 30, 45, 70, 100, 200]:
        for _ in range(2):
            base = [rnd.choice(voc) for _ in range(size)]
            for _ in range(10):
                w = list(base)
                for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, max(1, size // 20)])):
                    p, a = rnd.randrange(len(w)) if w else 0, rnd.random()
                    if a < 0.4 and w:
                        w[p] = rnd.choice(voc)
                    elif a < 0.7 and w:
                        del w[p]
                    else:
                        w.insert(p, rnd.choice(voc))
                rows.append((len(rows), " ".join(w) if rnd.random() < 0.9 else "\n".join(w).upper()))
    return rows + [(1000, None), (1001, ""), (1002, " \t "), (1003, "a"), (1004, "A"), (1005, "very " * 20_000)]


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_jaccard_join_against_brute_force(spark, k, percent):
    rows = near_rows()
    out = jaccard_join.link(docs_of(spark, rows), k, percent).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == brute.linked(rows, k, percent)


def test_jaccard_join_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "x y z q r s t"), (2, "x y z q r s t"), (3, "a b c d e f")]
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard_join.link(docs_of(spark, rows), 4, 85).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 1)]
    assert jaccard_join.link(docs_of(spark, []), 4, 85).count() == 0


def test_tree_join_loses_no_pair():
    rnd = np.random.default_rng(2)
    p, q = (rnd.poisson(3, (n, jaccard_join.DIMENSIONS)).astype(np.int32) for n in (300, 90))
    q[:40] = p[:40] + rnd.poisson(0.1, q[:40].shape)
    np_, nq = p.sum(axis=1), q.sum(axis=1)
    i, j = jaccard_join.tree_join(p, np_, q, nq, 80)
    bound = np.minimum(p[:, None, :], q[None, :, :]).sum(axis=2)
    want = np.argwhere(100 * bound >= 80 * (np_[:, None] + nq[None, :] - bound))
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, want.tolist())) and len(i) >= 40


def test_blocks_beyond_hubs_reach_the_tree(spark):
    """A chain whose ends are not linked: the hub links some, the tree finds the rest."""
    rnd = random.Random(9)
    words = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(words)
        for p in rnd.sample(range(120), 2):
            w[p] = f"n{i}-{p}"
        rows.append((i, " ".join(w)))
    out = {r.doc_id: tuple(r)[1:] for r in jaccard_join.link(docs_of(spark, rows), 4, 85).collect()}
    assert out == brute.linked(rows, 4, 85)


def test_words_of_long_texts_are_cut_at_gaps(monkeypatch):
    import pyarrow as pa

    texts = ["aa bb " * 300, "", None, "x" * 5000 + " y", "z"]
    whole = B.word_hashes(*B.column_bytes(pa.array(texts)), jaccard_join.GAP, jaccard_join.LOWER)
    monkeypatch.setattr(B, "SEGMENT", 64)
    parts = B.word_hashes(*B.column_bytes(pa.array(texts)), jaccard_join.GAP, jaccard_join.LOWER)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True)) and len(whole[0]) == 603


def test_components(spark):
    rnd = random.Random(6)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r.id: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}


def test_language_id_learns_and_predicts(spark):
    rnd = random.Random(8)
    voc = {"aa": ["ka", "ko", "ku", "kila"], "bb": ["sch", "und", "der", "über"], "cc": ["ñe", "los", "que", "ión"]}
    rows = [(i, " ".join(rnd.choices(voc[g], k=30)), g) for i, g in enumerate(list(voc) * 40)]
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], "doc_id long, text string, lang string, score double, row string")
    known = language_id.learn(df.where(language_id.learnable()), limit=10)
    assert known.langs == ["aa", "bb", "cc"]
    out = language_id.predict(df, known).collect()
    assert all(r.lang == r.lang_pred and 0 < r.score <= 1 and r.row == "x" for r in out)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !"), (4, "KA"), (5, "ж"), (6, "über " * 500_000), (None, "und")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(odd, known).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4, 6, None)] == ["und", "und", "und", "aa", "bb", "bb"]
    assert got[1][1] == got[3][1] == 0 and got[5][1] == 0
    assert language_id.predict(df.limit(0), known).count() == 0


def test_language_id_without_anything_to_learn(spark):
    df = spark.createDataFrame([(1, "text", None), (2, None, "aa")], "doc_id long, text string, lang string")
    known = language_id.learn(df)
    assert [(r.lang_pred, r.score) for r in language_id.predict(df, known).collect()] == [("und", 0.0)] * 2


def test_long_texts_are_counted_in_parts(monkeypatch):
    table = lambda points: points
    text = "one two three " * 900
    whole = language_id.grams([text], table, language_id.CODE_BITS)
    monkeypatch.setattr(language_id, "PART", 1000)
    parts = language_id.grams([text], table, language_id.CODE_BITS)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def standard():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_texts():
    rnd = random.Random(1)
    parts = ["'s", "'ll", " ", "  ", "\n", "\t", "é", "ß", "中", "😀", "1", "99", ".", "...", "Ab", "the", " the", "\x1c", "\xa0", "́", "'", "\x85", "　", "\x00"]
    fuzz = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(3000)]
    points = ["".join(f"a{chr(c)}b {chr(c)}{chr(c)}1  {chr(c)} " for c in range(a, a + 64)) for a in range(0, 0x3100, 64)]
    return [*fuzz, *points, "a" * 5000, " " * 3000, "é" * 2000, "<unk>", "<|endoftext|>", "▁a ▁", "a b  c \n d", " a", "a ", "a\n b"]


def test_bpe_equals_the_standard_encoder(standard):
    model, texts = byte_bpe.tokenizer(RANKS, public_tokenizers.PATTERN), bpe_texts()
    for text, ids in zip(texts, model.encode_all(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == standard.encode_ordinary(text)
        assert model.decode(ids) == text.encode()


def test_bpe_with_a_small_table_of_known_words(standard, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 5)
    model = byte_bpe.Tokenizer(RANKS, public_tokenizers.PATTERN)
    texts = [f"word{i} and more words {i}" for i in range(50)]
    assert [np.frombuffer(x, "<u4").tolist() for x in model.encode_all(texts)] == [standard.encode_ordinary(t) for t in texts]
    assert [np.frombuffer(model.encode(t), "<u4").tolist() for t in texts] == [standard.encode_ordinary(t) for t in texts]


def test_bpe_in_spark(spark, standard):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (None, "x"), (1, "again"), (4, "long word " * 20_000)]
    df = docs_of(spark, rows)
    encoded = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert sorted((r.doc_id or 0, r.ids) for r in encoded.collect()) == sorted((i or 0, standard.encode_ordinary(t or "")) for i, t in rows)
    back = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    assert sorted((r.doc_id or 0, bytes(r.data)) for r in back.collect()) == sorted((i or 0, (t or "").encode()) for i, t in rows)
    out = byte_bpe.digests(df, RANKS, public_tokenizers.PATTERN).collect()
    want = sorted((i or 0, len(standard.encode_ordinary(t or "")), brute.sha(t or "")) for i, t in rows)
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded_sha256) for r in out) == want
    assert byte_bpe.digests(docs_of(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


MESSAGES = "conv string, turn long, role string, text string, call_id string, tool string, arguments string, after string, answers string, level int"
SCHEMAS = {"sum": {"type": "object", "required": ["x"], "additionalProperties": False, "properties": {"x": {"type": "array", "items": {"type": "number"}}, "mode": {"enum": ["fast", "slow"]}}}}


def test_chat_links_order_and_checks(spark):
    call = lambda c, t, i, args='{"x": [1, 2.5]}', after=None, tool="sum": (c, t, "assistant", None, i, tool, args, after, None, 9)
    result = lambda c, t, i: (c, t, "tool", "done", None, None, None, None, i, 9)
    rows = [
        call("a", 3, "c1", after="c2"), call("a", 1, "c2"), call("a", 5, "c3", after="c1"), result("a", 6, "c3"), result("a", 7, "zz"),
        ("a", 0, "user", "hé \"q\"\n", None, None, None, None, None, 9), call("a", 8, "c2"),
        call("b", 0, "p", after="q"), call("b", 1, "q", after="p"), call("b", 2, "r", after="none"),
        call("b", 3, "s", '{"x": ["1"], "y": 1, "mode": "odd"}'), call("b", 4, "t", "{"), call("b", 5, "u", "{}", tool="other"), call("b", 6, "v", "{}"),
        (None, None, None, None, None, None, None, None, None, 9), call(None, 1, "w"),
    ]
    out = chat_tools.format_chats(spark.createDataFrame(rows, MESSAGES), SCHEMAS).collect()
    got = {(r.conv, r.turn): r for r in out}
    assert len(out) == len(rows)
    assert [got["a", t].level for t in (1, 3, 5)] == [0, 1, 2] and got["a", 6].linked and not got["a", 7].linked
    assert got["a", 8].repeated and not got["a", 1].repeated and got["a", 5].linked and not got["a", 3].linked
    assert got["b", 0].level == got["b", 1].level == -1 and got["b", 2].errors == ["after: no such call"]
    assert got["b", 3].errors == [".mode: not allowed", ".x[0]: not number", ".y: unknown"]
    assert got["b", 4].errors == [".: not JSON"] and got["b", 5].errors == ["tool: unknown"] and got["b", 6].errors == [".x: missing"]
    assert got["a", 0].json == '{"content":"hé \\"q\\"\\n","conversation":"a","role":"user","turn":0}'
    assert got["a", 1].json == '{"call":{"arguments":{"x":[1,2.5]},"id":"c2","level":0,"name":"sum"},"conversation":"a","role":"assistant","turn":1}'


def test_long_chains_and_repeated_identifiers(spark):
    rows = [("a", i, "assistant", None, f"c{i}", "sum", '{"x": []}', f"c{i - 1}" if i else None, None, 1) for i in range(300)]
    rows += [("h", i, "assistant", str(i), "same", "sum", '{"x": []}', None, None, 1) for i in range(200)]
    rows += [("h", 1000 + i, "tool", "r", None, None, None, None, "same", 1) for i in range(200)]
    out = chat_tools.format_chats(spark.createDataFrame(rows, MESSAGES), SCHEMAS).collect()
    assert len(out) == 700
    assert sorted(r.level for r in out if r.conv == "a") == list(range(300))
    assert sum(not r.repeated for r in out if r.conv == "h" and r.role == "assistant") == 1
    assert chat_tools.format_chats(spark.createDataFrame([], MESSAGES), SCHEMAS).count() == 0


def test_exchanges_as_calls(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a question that is long enough"), (1, 2, "assistant", "x"), (1, 3, "user", "short"), (2, 1, "assistant", "y")]
    messages = chat_tools.exchange_calls(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    got = {(r.conv, r.turn): (r.call_id, r.linked, r.level, r.n_errors) for r in chat_tools.format_chats(messages, chat_tools.reply_schema()).collect()}
    assert got == {(1, 0): (None, False, None, 0), (1, 1): ("t1", True, 0, 0), (1, 2): ("t1", True, 0, 0), (1, 3): ("t3", False, 1, 1), (2, 1): ("t0", False, None, 1)}
