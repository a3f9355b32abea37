import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.operators import changes
from rillmark.sources import feed as feeds
from rillmark.spec import TableSpec, replicated_tables, source_foreign_keys, source_tables

ROW = "struct<id:int,v:string>"
FEED = f"op string, ts_ms long, before {ROW}, after {ROW}, seq long"


def ev(op, ts, key, v=None, seq=0):
    row = (key, v)
    return (op, ts, row if op == "d" else None, None if op == "d" else row, seq)


def test_filter_and_flatten(spark):
    rows = [ev("c", 1, 1, "a"), ("u", 2, None, None, 0), ev("d", 3, 1), ("x", 4, None, (1, "z"), 0)]
    got = changes.flatten(changes.storable(spark.createDataFrame(rows, FEED))).collect()
    assert [(r.id, r.v, r.cdc_ts_ms, r.cdc_op) for r in got] == [(1, "a", 1, "c")]


def test_mark_is_strict_and_late_events_are_the_rest(spark):
    df = spark.createDataFrame([ev("c", t, t) for t in (9, 10, 11)], FEED)
    assert [r.ts_ms for r in changes.newer_than(df, 10).collect()] == [11]
    assert [r.ts_ms for r in changes.late_events(df, 10).collect()] == [9, 10]
    assert changes.newer_than(df, None).count() == 3 and changes.late_events(df, None).count() == 0
    assert changes.newer_than(df, 10, lookback_ms=1).count() == 2


def test_tie_in_one_millisecond_goes_to_the_later_sequence(spark):
    rows = [ev("u", 5, 1, "first", 1), ev("u", 5, 1, "second", 2)]
    df = changes.flatten(changes.storable(spark.createDataFrame(rows, FEED)), ["seq"])
    got = changes.latest_per_key(df, ["id"], changes.newest_first(ties=["seq"])).collect()
    assert [r.v for r in got] == ["second"]


def test_deletes_end_a_key_and_inserts_revive_it(spark):
    rows = [ev("r", 1, 1, "a"), ev("d", 2, 1, seq=1), ev("r", 1, 2, "b"), ev("d", 2, 2, seq=1),
            ev("c", 3, 2, "again", 2), ("u", 9, None, None, 9)]
    got = changes.current_state_with_deletes(spark.createDataFrame(rows, FEED), ["id"]).collect()
    assert [(r.id, r.v) for r in got] == [(2, "again")]


def test_null_keys_do_not_collapse(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "id int, cdc_ts_ms long")
    ok, bad = changes.split_null_keys(df, ["id"])
    assert ok.count() == 1 and bad.count() == 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_split_into_batches_gives_the_same_state(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(12), rnd.randrange(40), i) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, cdc_ts_ms long, seq long")
    spec = TableSpec("t", ("id",), "id INT")
    whole = {tuple(r) for r in changes.current_state(df, spec, ["seq"]).collect()}
    cut = df.withColumn("b", F.lit(0))
    for n in range(rnd.randrange(1, 6)):
        cut = cut.withColumn("b", F.when(F.col("seq") > rnd.randrange(200), n).otherwise(F.col("b")))
    order = changes.newest_first(ties=["seq"])
    stored = changes.latest_per_key(cut, ["id", "b"], order).drop("b")
    assert {tuple(r) for r in changes.current_state(stored, spec, ["seq"]).collect()} == whole
    want = {}
    for r in rows:
        if r[0] not in want or (r[1], r[2]) > want[r[0]][1:]:
            want[r[0]] = r
    assert whole == set(want.values())


def test_conform_never_wraps(spark):
    df = spark.createDataFrame(
        [(40000, "7", 1.5), (-32768, "x", None), (5, " 12 ", 2.0)], "a int, b string, c double")
    schema = T.StructType().add("a", T.ShortType()).add("b", T.ShortType()).add("c", T.FloatType()).add("d", T.DateType())
    got = changes.conform(df, schema).collect()
    assert [(r.a, r.b, r.n_bad) for r in got] == [(None, 7, 1), (-32768, None, 1), (5, 12, 0)]
    assert got[0].d is None and got[0].c == 1.5


def test_conform_reads_day_numbers_as_dates(spark):
    df = spark.createDataFrame([(9000, 2**40), (None, 1)], "a int, b long")
    got = changes.conform(df, T.StructType().add("a", T.DateType()).add("b", T.DateType())).collect()
    assert [(str(r.a), str(r.b), r.n_bad) for r in got] == [
        ("1994-08-23", "None", 1), ("None", "1970-01-02", 0)]


def test_counts_and_mark(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (2, 6)], "id int, cdc_ts_ms long")
    assert tuple(changes.batch_counts(df, ["id"]).first()) == (3, 2, 7)
    assert tuple(changes.batch_counts(df.where("false"), ["id"]).first()) == (0, 0, None)
    feed = spark.createDataFrame([ev("c", 5, 1), ev("d", 9, 1)], FEED)
    assert changes.high_water_mark(feed).first()[0] == 9


def test_reconcile_counts_null_keys_on_their_side(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    got = {r.side: (r["keys"], r.source_rows, r.stored_rows) for r in changes.reconcile(a, b, ["k"]).collect()}
    assert got == {"only_source": (2, 2, 0), "both": (1, 2, 1), "only_stored": (1, 0, 1)}


def test_snapshot_and_union(spark):
    rows = spark.createDataFrame([(1, "a")], "id int, v string")
    snap = changes.snapshot_as_feed(rows, F.lit(1), F.lit(0))
    feed = changes.unite(snap, spark.createDataFrame([ev("u", 2, 1, "b", 1)], FEED))
    got = changes.current_state_with_deletes(feed, ["id"]).collect()
    assert [(r.v, r.cdc_op) for r in got] == [("b", "u")]


def test_sample_and_next_key(spark):
    df = spark.range(1000)
    one = [r.id for r in changes.sample_k(df, "id", 5).collect()]
    assert len(set(one)) == 5 and one == [r.id for r in changes.sample_k(df.repartition(7), "id", 5).collect()]
    assert changes.next_key(df, "id", 10).first()[0] == 1000
    assert changes.next_key(df.where("id < 0"), "id", 10).first()[0] == 11


def test_rank_filter_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as cdc_ts_ms")
    plan = changes.latest_per_key(df, ["k"], changes.newest_first())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_scan_outcomes_and_pruning(spark, folder):
    assert feeds.try_scan(spark, folder + "/nothing")[0] == feeds.UNREADABLE
    spark.createDataFrame([], FEED).write.parquet(folder + "/empty")
    assert feeds.try_scan(spark, folder + "/empty")[0] == feeds.EMPTY
    day = 86_400_000
    rows = spark.createDataFrame([ev("c", d * day, d) for d in (10, 11, 12)], FEED)
    rows.selectExpr("*", "1970 as year", "1 as month", "int(ts_ms / 86400000) + 1 as day").write.partitionBy(
        "year", "month", "day").parquet(folder + "/raw")
    status, df, _ = feeds.try_scan(spark, folder + "/raw", since_ms=12 * day, slack_days=1)
    assert status == feeds.OK and sorted(r.ts_ms // day for r in df.collect()) == [11, 12]
    assert df.select("_metadata.file_path").distinct().count() == 2
    assert feeds.try_scan(spark, folder + "/raw")[1].count() == 3


def test_files_are_found_alike_with_and_without_a_mark(spark, folder):
    for i, part in enumerate(("", "/sub", "/sub/deeper")):
        spark.createDataFrame([ev("c", 5 + i, i)], FEED).write.mode("append").parquet(f"{folder}/raw{part}")
    assert [feeds.scan_change_log(spark, folder + "/raw", since_ms=m).count() for m in (None, 1)] == [3, 3]


def test_route_include_tombstones(spark):
    df = spark.createDataFrame([("db.public.orders", "x"), ("db.orders", None)], "topic string, value string")
    assert [r.table for r in feeds.routed(df).collect()] == ["orders", "db.orders"]
    assert feeds.without_tombstones(df).count() == 1
    src = spark.createDataFrame([(("orders",),), (("other",),)], "source struct<table:string>")
    assert feeds.included(src, ["orders"]).count() == 1


def test_declared_tables(spark):
    assert len(source_tables()) == 14 and len(source_foreign_keys()) == 13
    orders = replicated_tables()["orders"]
    assert [f.dataType.simpleString() for f in orders.stored_schema().fields[-2:]] == ["bigint", "string"]
    names = source_tables()
    for fk in source_foreign_keys():
        assert fk.column in names[fk.child].schema().names
        assert fk.parent_column in names[fk.parent].schema().names
