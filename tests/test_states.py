"""Results kept up to date batch by batch, against working them out anew."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rillmark.operators import changes, integrity, quality
from rillmark.operators.check_states import CheckStates
from rillmark.operators.key_bitmaps import KeyBitmaps
from rillmark.operators.value_tree import ValueTree, differing_leaves, reconcile_values, tree
from rillmark.sinks.current import SHARD, CurrentTable
from rillmark.spec import ForeignKey, TableSpec
from rillmark.streaming import ingest

ROW = "struct<a:int,b:string,v:string>"
FEED = f"op string, ts_ms long, before {ROW}, after {ROW}, seq long"
SPEC = TableSpec("items", ("a", "b"), "a INT, b STRING, v STRING")
T0 = 1_700_000_000_000


@pytest.fixture
def name(spark):
    made = f"kept_{random.randrange(10**9)}"
    yield made
    for table in (made, f"{made}_keys", f"{made}_days"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def events(seed, n=200, keys=12):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        row = (rnd.randrange(keys), rnd.choice("xy"), f"v{i}")
        op = rnd.choice("cuurd")
        rows.append((op, T0 + rnd.randrange(50) * 1000, row if op == "d" else None, None if op == "d" else row, i))
    return rows


def live(df):
    return {(r.a, r.b, r.v, r.cdc_ts_ms, r.cdc_op) for r in df.collect()}


@pytest.mark.parametrize("seed,batches", [(1, 1), (2, 3), (3, 5)])
def test_merged_batches_equal_a_ranking_of_all(spark, folder, name, seed, batches):
    table = CurrentTable.open(spark, name, folder + "/t", SPEC, shards=4)
    rows = events(seed)
    for n in range(batches):
        batch = spark.createDataFrame(rows[n::batches], FEED)
        table.merge(ingest.stream_rows(batch, SPEC, ("seq",), True))
        if n == 0:
            table.merge(ingest.stream_rows(batch, SPEC, ("seq",), True))  # repeated after a fault
    want = changes.current_state_with_deletes(spark.createDataFrame(rows, FEED), ["a", "b"])
    assert live(table.live()) == live(want)
    assert table.rows().count() == len({(x[3] or x[2])[:2] for x in rows})


def one(op, ts, a, v, seq):
    row = (a, "x", v)
    return (op, T0 + ts, row if op == "d" else None, None if op == "d" else row, seq)


def test_only_touched_shards_are_written(spark, folder, name):
    table = CurrentTable.open(spark, name, folder + "/t", SPEC, shards=8)
    take = lambda rows: table.merge(ingest.stream_rows(spark.createDataFrame(rows, FEED), SPEC, ("seq",), True))
    assert take([one("c", 0, k, "v", k) for k in range(300)]) == list(range(8))
    before = {f: m for f, m in spark.read.parquet(folder + "/t").select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()}
    touched = take([one("u", 5, 7, "w", 900)])
    assert len(touched) == 1
    after = {f: m for f, m in spark.read.parquet(folder + "/t").select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()}
    changed = {re.search(rf"{SHARD}=(\d+)", f)[1] for f in set(before) ^ set(after)}
    assert changed == {str(touched[0])}
    assert take([one("u", 4, 7, "older", 901)]) == touched and {r.v for r in table.live().where("a = 7").collect()} == {"w"}
    assert take([(None, None, None, (None, "x", "v"), 1)]) == []


def test_the_table_is_not_exchanged(spark, folder, name):
    table = CurrentTable.open(spark, name, folder + "/t", SPEC, shards=2)
    table.merge(ingest.stream_rows(spark.createDataFrame([one("c", 0, k, "v", k) for k in range(50)], FEED), SPEC, ("seq",), True))
    batch = ingest.stream_rows(spark.createDataFrame([one("u", 9, 3, "w", 99)], FEED), SPEC, ("seq",), True)
    merged = table.merged(batch.withColumn(SHARD, F.lit(0)), [0, 1])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("SortMergeJoin"):]
    base = side[: side.index("Exchange")]
    assert "Bucketed: true" in base or "Bucketed: true" in side
    # One exchange brings the batch to the buckets; none stands over the table's scan.
    for block in re.split(r"(?=\+- Exchange|: *\+- Exchange)", side)[1:]:
        assert f"{name}" not in block.split("\n+-")[0] or "Scan ExistingRDD" in block


def test_deletes_are_kept_until_they_are_swept(spark, folder, name):
    table = CurrentTable.open(spark, name, folder + "/t", SPEC, shards=2)
    take = lambda *rows: table.merge(ingest.stream_rows(spark.createDataFrame(list(rows), FEED), SPEC, ("seq",), True))
    take(one("c", 0, 1, "v", 1), one("c", 0, 2, "v", 2))
    take(one("d", 10, 1, None, 3))
    take(one("u", 5, 1, "late", 4))
    assert [r.a for r in table.live().collect()] == [2] and table.rows().count() == 2
    assert table.sweep(T0 + 10) == 0 and table.sweep(T0 + 11) == 1
    assert table.rows().count() == 1 and table.sweep(T0 + 11) == 0
    again = CurrentTable.open(spark, name, folder + "/t", SPEC, buckets=3, shards=99)
    assert (again.buckets, again.shards) == (table.buckets, 2)


def test_sweeping_a_shard_empty(spark, folder, name):
    table = CurrentTable.open(spark, name, folder + "/t", SPEC, shards=1)
    table.merge(ingest.stream_rows(spark.createDataFrame([one("d", 0, 1, None, 1)], FEED), SPEC, ("seq",), True))
    assert table.sweep(T0 + 1) == 1 and table.rows().count() == 0


# --- checks ----------------------------------------------------------------
FLAT = "a long, b string, cdc_ts_ms long, cdc_op string"
DAY = 86_400_000


def flat_rows(seed, n=300):
    rnd = random.Random(seed)
    return [
        (rnd.choice([None, *range(60)]), rnd.choice([None, "x", "y", "y"]), T0 + rnd.randrange(6) * DAY + rnd.randrange(1000), rnd.choice(["c", "u", "r", "d", "?", None]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("keys", [{"a": "BIGINT"}, {"a": "BIGINT", "b": "STRING"}])
def test_states_add_up_to_the_report_over_rows(spark, folder, name, keys):
    rows = flat_rows(len(keys))
    states = CheckStates.open(spark, name, folder + "/s", keys)
    for n in range(3):
        states.add(spark.createDataFrame(rows[n::3], FLAT), n)
    states.add(spark.createDataFrame(rows[0::3], FLAT), 0)  # repeated after a fault
    df = spark.createDataFrame(rows, FLAT)
    for first, last in (("2023-11-14", "2023-11-19"), ("2023-11-15", "2023-11-16"), ("2023-11-17", "2023-11-17"), ("2020-01-01", "2020-01-02")):
        day = F.timestamp_millis("cdc_ts_ms").cast("date")
        some = df.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        want = quality.dq_report(some, list(keys), T0 + 9 * DAY).collect()
        assert sorted(map(tuple, states.report(first, last, T0 + 9 * DAY).collect())) == sorted(map(tuple, want))
        exact = quality.batch_profile(some, list(keys)).first()
        got = states.profile(first, last).first()
        for figure in ("bad_ops", "storable_keys", "newest_ms", "total", "keyed_rows", "keys", "single_keys"):
            assert got[figure] == exact[figure], figure
        assert abs(got["about_keys"] - exact["keys"]) <= 0.05 * exact["keys"] + 1
    plan = states.key_counts("2023-11-14", "2023-11-19")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


# --- values ----------------------------------------------------------------
VALUES = "k int, name string, amount double"


def plain_difference(left, right):
    from collections import Counter

    a, b, out = Counter(left), Counter(right), {}
    for k in {r[0] for r in left + right}:
        mine, other = {r: n for r, n in a.items() if r[0] == k}, {r: n for r, n in b.items() if r[0] == k}
        if mine != other:
            out[k] = "only_source" if not other else "only_stored" if not mine else "value"
    return out


@pytest.mark.parametrize("listed", [0, 1000])
def test_values_are_compared_in_leaves_that_differ(spark, monkeypatch, listed):
    monkeypatch.setattr("rillmark.operators.value_tree.LISTED", listed)
    rnd = random.Random(4)
    left = [(k, rnd.choice([None, "n", ""]), k / 7) for k in range(400)] + [(5, "n", 1.0)] * 3 + [(None, "n", 0.0)]
    right = [r for r in left if r[0] != 17] + [(900, None, None)]
    right = [(k, n, a + 1 if k == 30 else a) for k, n, a in right]
    right.remove((5, "n", 1.0))
    right = [(k, "" if (k, n) == (next(r[0] for r in left if r[1] is None), None) else n, a) for k, n, a in right]
    a, b = (spark.createDataFrame(rows, VALUES).repartition(3) for rows in (left, right))
    got = {r.k: r.difference for r in reconcile_values(a, b, ["k"], ["name", "amount"], 64, 8).collect()}
    assert got == plain_difference(left, right) and len(got) == 5
    assert reconcile_values(a, a.repartition(5), ["k"], ["name", "amount"], 64, 8).count() == 0


def test_few_leaves_differ_where_few_rows_do(spark):
    a = spark.range(20_000).selectExpr("cast(id as int) as k", "cast(id as string) as name", "id / 3 as amount")
    b = a.withColumn("amount", F.when(F.col("k") % 10_000 == 1, 0.0).otherwise(F.col("amount")))
    sides = [tree(x, ["k"], ["name", "amount"], 4096, 64) for x in (a, b)]
    assert differing_leaves(*sides).count() == 2
    none = ValueTree(sides[0].leaves.limit(0))
    assert differing_leaves(none, sides[0]).count() == sides[0].leaves.count()


def test_rows_are_compared_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr("rillmark.operators.value_tree.TASK_ROWS", 1_000, raising=False)
    a = spark.range(20_000).selectExpr("cast(id as int) as k", "cast(id % 7 as string) as name", "id / 3 as amount")
    b = a.withColumn("amount", F.when(F.col("k") % 10 == 1, 0.0).otherwise(F.col("amount")))
    out = reconcile_values(a, b, ["k"], ["name", "amount"], 64, 8)
    rows = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in rows) == 2_000 and len(rows) >= 20
    assert max(r["count"] for r in rows) <= 200


# --- keys ------------------------------------------------------------------
def test_bitmaps_equal_an_anti_join(spark, folder):
    rnd = random.Random(8)
    edge = [0, 1, -1, 32_767, 32_768, 32_769, -32_768, -32_769, 2**31, -(2**31), 2**62, None]
    parents = edge + [rnd.randrange(-10**6, 10**6) for _ in range(500)]
    children = edge + [x + d for x in edge[:-1] for d in (-1, 1)] + [rnd.choice(parents) for _ in range(300)] + [rnd.randrange(-10**6, 10**6) for _ in range(300)]
    p, c = spark.createDataFrame([(x,) for x in parents], "id long"), spark.createDataFrame([(x,) for x in children], "ref long")
    index = KeyBitmaps(spark, folder + "/i")
    for n in range(3):
        index.add(p.where(F.coalesce(F.pmod("id", F.lit(3)), F.lit(0)) == n), "p", "id", n)
    got = {(r.fk_value, r.rows) for r in index.orphans(c, "ref", "p", "id").collect()}
    assert got == {(r.fk_value, r.rows) for r in integrity.orphan_keys(c, "ref", p, "id").collect()} and got
    early = index.orphans(c, "ref", "p", "id", up_to=0)
    want = integrity.orphan_keys(c, "ref", p.where(F.pmod("id", F.lit(3)) == 0), "id")
    assert {tuple(r) for r in early.collect()} == {tuple(r) for r in want.select("fk_value", "rows").collect()}


def test_rows_of_a_batch_may_point_to_each_other(spark, folder):
    index = KeyBitmaps(spark, folder + "/i")
    own = ForeignKey("staff", "boss", "staff", "id")
    batch = lambda rows: {"staff": spark.createDataFrame(rows, "id int, boss int")}
    first = index.check_batch(batch([(1, None), (2, 1), (3, 4)]), [own], 0).first()
    assert (first["orphan_values"], first["orphan_rows"]) == (1, 1)
    second = index.check_batch(batch([(4, 3), (5, 9), (6, 9)]), [own], 1).first()
    assert (second["orphan_values"], second["orphan_rows"]) == (1, 2)
    index.add(batch([(4, 3)])["staff"], "staff", "id", 1)  # taken again, smaller: its own place is replaced
    assert {r.fk_value for r in index.orphans(spark.createDataFrame([(5,), (4,)], "x int"), "x", "staff", "id").collect()} == {5}
    with pytest.raises(TypeError):
        index.add(spark.createDataFrame([("a",)], "id string"), "p", "id", 0)
    with pytest.raises(ValueError):
        index.check_batch({}, [own], 2)
    assert KeyBitmaps(spark, folder + "/none").known("p", "id").count() == 0
