"""What a task holds of many texts or many keys at a time."""

import random
import tracemalloc

import numpy as np
import pandas as pd
import public_tokenizers

from rillmark.llm import bytes_np as B
from rillmark.llm import byte_bpe, jaccard_join, language_id


def peak(work):
    tracemalloc.start()
    work()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_predicting_holds_the_grams_of_few_texts(monkeypatch):
    monkeypatch.setattr(language_id, "PART", 20_000)
    letters = np.arange(97, 123)
    kept = pd.DataFrame({"lang": "aa", "code": letters, "r": np.arange(1, 27)})
    known = language_id.profiles(kept, letters, 300)
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=500)) for _ in range(1600)]
    one_by_one = [language_id.predict_texts([t], known) for t in texts[:50]]
    some = peak(lambda: language_id.predict_texts(texts[:200], known))
    many = peak(lambda: language_id.predict_texts(texts, known))
    assert many < 1.5 * some
    langs, scores = language_id.predict_texts(texts[:50], known)
    assert langs == [lang for (lang,), _ in one_by_one] and scores.tolist() == [score[0] for _, score in one_by_one]


def packed_keys(parts):
    """Keys of two documents each, packed and sorted by part, a batch at a time."""
    rnd = np.random.default_rng(5)
    for p in range(parts):
        keys = np.repeat(rnd.integers(0, 1 << 39, 20_000, dtype=np.uint64), 2)
        docs = np.arange(len(keys), dtype=np.int64)
        none = np.zeros(len(keys), dtype=np.uint32)
        yield from B.packed(B.OPEN, np.full(len(keys), p), [keys, docs, none, none.view(np.int32)], key=True)


def test_keys_are_gathered_part_by_part():
    found = []

    def gather(parts):
        found.append(sum(batch.num_rows for batch in jaccard_join._gather(packed_keys(parts))))

    one, eight = peak(lambda: gather(1)), peak(lambda: gather(8))
    assert found == [40_000, 320_000]
    assert eight < 3 * one


def test_keys_are_passed_on_before_they_are_many():
    rnd = random.Random(4)
    rows = [(i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(400))) for i in range(4000)]
    batch = B.pa.RecordBatch.from_pydict({"id": [r[0] for r in rows], "body": [r[1] for r in rows]})
    sent = [out for out in jaccard_join._emit(4, 85, 8)(iter([batch])) if out.column("kind")[0].as_py() != B.STATS]
    keys = [sum(len(a.as_py()) // 5 for a in out.column("a")) for out in sent]
    assert sum(keys) > 450_000 > max(keys)


def test_sets_come_from_small_batches(spark, folder, monkeypatch):
    path, real = folder + "/bytes", B.tidy

    def recorded(over):
        def run(batches):
            def seen():
                for batch in batches:
                    with open(path, "a") as f:
                        f.write(f"{batch.nbytes}\n")
                    yield batch

            yield from over(seen())

        return real(run)

    monkeypatch.setattr(B, "tidy", recorded)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = spark.range(0, 300, 1, 1).selectExpr("id", "concat_ws(' ', transform(sequence(1, 8000), x -> x + id)) AS body")
    sets = jaccard_join.sets_of(rows, 4)
    assert sets.selectExpr("min(length(hashes))", "count(1)").first() == (7997 * 8, 300)
    with open(path) as f:
        sizes = [int(x) for x in f]
    assert sum(sizes) > 10_000_000 > 2 * max(sizes)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_words_that_a_task_has_seen_do_not_stay_in_its_worker(spark, monkeypatch):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    tasks = []

    class Docs:
        """Runs a mapInArrow's function here."""

        columns = ("doc_id", "text")

        def __getitem__(self, name):
            return spark.range(1).id

        def select(self, *_):
            return self

        def mapInArrow(self, over, schema):
            tasks.append(over)
            return self

        def withColumnRenamed(self, *_):
            return self

    byte_bpe.digests(Docs(), path, pattern)
    batch = B.pa.RecordBatch.from_pydict({"id": [1, 2], "body": ["some words here", None]})
    first = [b.to_pylist() for b in tasks[0](iter([batch]))]
    model = byte_bpe.tokenizer(path, pattern)
    assert not model.known and not model.spaced
    assert [b.to_pylist() for b in tasks[0](iter([batch]))] == first and first[0][0]["n_tokens"] > 0


def test_points_of_leaves_come_in_small_batches(spark, monkeypatch):
    sizes, real = {}, jaccard_join.saved

    def seen(df, purpose):
        sizes[purpose] = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        return real(df, purpose)

    monkeypatch.setattr(jaccard_join, "saved", seen)
    rows = [(i, " ".join(f"w{j + i // 2}" for j in range(60))) for i in range(6)]
    jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert sizes["near-pairs"] == sizes["open-pairs"] == "1000"
