"""Columns that appear, widen or clash over the files of a table."""

import pytest

from rillmark.plans.batch_run import RunConfig, run_table
from rillmark.sources import feed
from rillmark.sources.schema_ledger import SchemaConflict, SchemaLedger, leaves, union, wide
from rillmark.spec import TableSpec

T0 = 1_700_000_000_000


def put(spark, path, row, values, day=None):
    schema = f"op string, ts_ms long, after struct<{row}>"
    where = path if day is None else f"{path}/year=2023/month=11/day={day}"
    spark.createDataFrame([("c", T0 + i, v) for i, v in enumerate(values)], schema).coalesce(1).write.mode("append").parquet(where)


def test_columns_are_found_in_the_first_file_that_has_them(spark, folder):
    ledger = SchemaLedger(spark, folder + "/ledger", "t")
    assert ledger.rows() == [] and ledger.schema().fieldNames() == []
    put(spark, folder + "/raw", "id:int", [(1,)], 14)
    assert ledger.update(folder + "/raw") == 3
    assert ledger.update(folder + "/raw") == 0
    for n in range(5):
        put(spark, folder + "/raw", "id:int" + (",extra:string" if n >= 3 else ""), [(n, "x")[: 2 if n >= 3 else 1]], 15)
    put(spark, folder + "/raw", "id:bigint,extra:string", [(2**40, "y")], 16)
    assert ledger.update(folder + "/raw") == 2
    found = ledger.first_files()
    assert set(found) == {("op", "string"), ("ts_ms", "bigint"), ("after.id", "int"), ("after.id", "bigint"), ("after.extra", "string")}
    assert "day=16" in found["after.id", "bigint"] and "day=15" in found["after.extra", "string"]
    assert spark.read.parquet(found["after.extra", "string"]).select("after.extra").count() == 1
    assert dict(leaves(ledger.schema())) == {"op": "string", "ts_ms": "bigint", "after.id": "bigint", "after.extra": "string"}
    rows = feed.scan_change_log(spark, folder + "/raw", schema=ledger.schema()).select("after.id", "after.extra").collect()
    assert len(rows) == 7 and {(r.id, r.extra) for r in rows} >= {(1, None), (2**40, "y"), (3, "x")}
    other = SchemaLedger(spark, folder + "/ledger", "u")
    assert other.rows() == []


def test_only_new_files_are_looked_at(spark, folder, monkeypatch):
    ledger, looked = SchemaLedger(spark, folder + "/ledger", "t"), []
    merged = SchemaLedger._merged
    monkeypatch.setattr(SchemaLedger, "_merged", lambda self, files: looked.extend(files) or merged(self, files))
    for day in (14, 15):
        put(spark, folder + "/raw", "id:int", [(1,)], day)
    ledger.update(folder + "/raw")
    first = len(set(looked))
    looked.clear()
    put(spark, folder + "/raw", "id:int", [(2,)], 15)
    ledger.update(folder + "/raw")
    # The newest moment is looked at again, for files that came within it.
    assert first == 2 and 1 <= len(set(looked)) <= 2 and not any("day=14" in f for f in looked)


def test_types_with_no_common_wide_type(spark, folder):
    ledger = SchemaLedger(spark, folder + "/ledger", "t")
    put(spark, folder + "/raw", "id:int", [(1,)])
    put(spark, folder + "/raw", "id:string", [("a",)])
    assert ledger.update(folder + "/raw") == 4
    with pytest.raises(SchemaConflict):
        ledger.schema()
    assert wide(["int", "smallint"]) == "bigint" and wide(["float"]) == "double" and wide(["date"]) == "date"
    for clash in ([("a", "int"), ("a.b", "int")], [("a.b", "int"), ("a", "int")], [("a", "int"), ("a", "double")]):
        with pytest.raises(SchemaConflict):
            union(clash)


def test_a_run_sees_columns_of_later_files(spark, folder):
    spec = TableSpec("items", ("id",), "id INT, n SMALLINT, v STRING")
    cfg = RunConfig(folder + "/raw", folder + "/bronze", folder + "/state")
    put(spark, folder + "/raw/items", "id:int,n:int", [(1, 5)])
    put(spark, folder + "/raw/items", "id:int,n:bigint,v:string", [(2, 2**40, "x"), (3, 7, "y")])
    out = run_table(spark, spec, cfg, T0 + 10)
    assert (out["status"], out["rows_written"], out["values_misfit"]) == ("ok", 3, 1)
    got = {(r.id, r.n, r.v) for r in spark.read.parquet(folder + "/bronze/items").collect()}
    assert got == {(1, 5, None), (2, None, "x"), (3, 7, "y")}
