import pytest

from rillmark.operators import integrity
from rillmark.spec import ForeignKey, source_foreign_keys, source_tables


@pytest.fixture(scope="module")
def tables(spark):
    """All source tables, with one row in each and some faults in orders."""
    out = {}
    for name, spec in source_tables().items():
        schema = ", ".join(f"{f.name} {f.dataType.simpleString() if 'char' not in f.dataType.simpleString() else 'string'}"
                           for f in spec.schema().fields)
        out[name] = spark.createDataFrame([], schema)

    def row(name, **values):
        names = out[name].columns
        return spark.createDataFrame([tuple(values.get(c) for c in names)], out[name].schema)

    out["customers"] = row("customers", customer_id="ALFKI", company_name="A")
    out["employees"] = row("employees", employee_id=1, last_name="L", first_name="F", reports_to=2)
    out["orders"] = (
        row("orders", order_id=1, customer_id="ALFKI", employee_id=1)
        .union(row("orders", order_id=1, customer_id="LONG-ID", employee_id=9))
        .union(row("orders", customer_id="ALFKI"))
    )
    return out


def test_all_foreign_keys(spark, tables):
    got = {(r.child, r.fk_column): r.orphan_rows for r in
           integrity.foreign_key_report(tables, source_foreign_keys()).collect()}
    assert len(got) == 13
    # A null key refers to nothing; a table may refer to itself.
    assert {k: v for k, v in got.items() if v} == {
        ("orders", "customer_id"): 1, ("orders", "employee_id"): 1, ("employees", "reports_to"): 1}


def test_orphans_are_counted_per_value(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(2,), (None,)], "fk int")
    parent = spark.createDataFrame([(2,)], "id int")
    assert [tuple(r) for r in integrity.orphan_keys(child, "fk", parent, "id").collect()] == [(1, 50)]
    rep = integrity.foreign_key_report({"c": child, "p": parent}, [ForeignKey("c", "fk", "p", "id")]).first()
    assert (rep.orphan_values, rep.orphan_rows) == (1, 50)


def test_table_constraints(spark, tables):
    got = {(r.constraint, r.column_name): r.violation_rows for r in
           integrity.table_constraints(tables["orders"], source_tables()["orders"]).collect()}
    assert {k: v for k, v in got.items() if v} == {
        ("not_null", "order_id"): 1, ("max_length", "customer_id"): 1,
        ("key_not_null", "order_id"): 1, ("key_unique", "order_id"): 2}
    assert ("max_length", "ship_name") in got
