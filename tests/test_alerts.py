import json

from pyspark.sql import functions as F

from rillmark import fixed_values as fv
from rillmark.functions import severity, text
from rillmark.operators import alerts
from rillmark.plans.batch_run import failure_counts
from rillmark.sinks.state import OUTCOME_SCHEMA


def test_dedup_and_message_keys(spark):
    df = spark.createDataFrame([("orders", "null_pk", "x"), ("orders", "null_pk", ""), ("orders", "null_pk", None)],
                               "t string, e string, s string")
    keys = [r[0] for r in df.select(text.dedup_key(F.col("t"), F.col("e"), F.col("s"))).collect()]
    assert keys == ["cdc-orders-null_pk-x", "cdc-orders-null_pk", "cdc-orders-null_pk"]
    assert df.select(text.message_key(F.col("t"), F.col("e"))).first()[0] == "orders:null_pk"


def test_delivery_severity(spark):
    df = spark.createDataFrame([("spark_not_running",), ("null_pk",), ("stale_data",), ("unhandled_exception",), ("?",)], "e string")
    level = severity.delivery_severity(F.col("e"))
    got = [tuple(r) for r in df.select(level["sev_label"], level["severity"], severity.display_label(F.col("e"))).collect()]
    assert got == [("SEV-1", "critical", "SEV-1"), ("SEV-2", "error", "SEV-2"), ("SEV-3", "warning", "SEV-3"),
                   ("SEV-1", "critical", "SEV-1"), ("SEV-2", "error", "SEV-?")]


def test_trigger_and_resolve_messages(spark):
    df = spark.createDataFrame([("orders", 1_700_000_000_123)], "t string, ts long")
    trig = alerts.trigger_events(df, table=F.col("t"), error_type=F.lit("null_pk"), summary=F.lit("s"),
                                 severity=F.lit("error"), details=F.lit(None).cast("string"), ts_ms=F.col("ts"))
    row = alerts.as_messages(trig, alerts.TRIGGER_FIELDS).first()
    body = json.loads(row["value"])
    assert row["key"] == "orders:null_pk" and set(body) == set(alerts.TRIGGER_FIELDS)
    assert body["component"] == "spark-cdc/orders" and body["timestamp"] == "2023-11-14T22:13:20.123+00:00"
    assert body["custom_details"] == {} and body["group"] == "data-quality"
    res = alerts.resolve_events(df, table=F.col("t"), error_type=F.lit("null_pk"), ts_ms=F.col("ts"), suffix=F.lit("r1"))
    body = json.loads(alerts.as_messages(res, alerts.RESOLVE_FIELDS).first()["value"])
    assert set(body) == set(alerts.RESOLVE_FIELDS) and body["dedup_key"] == "cdc-orders-null_pk-r1"


def hook(*alerts_):
    return json.dumps({"alerts": list(alerts_)})


def alert(title, status="firing", **labels):
    return {"status": status, "labels": {"alertname": title, **labels}, "annotations": {}}


def test_webhook_cases(spark):
    bodies = [
        (hook(alert("CDC Kafka Broker Unreachable"), alert("CDC Data Freshness SLA Breach", "resolved", table="orders")),),
        (hook(alert("DatasourceError"), alert("\U0001f535 SEV-4 (Low)"), alert("New rule")),),
        (hook(),), ("{}",), ("not json",), (json.dumps({"alerts": [{"status": "firing"}]}),),
        (json.dumps({"alerts": [{"labels": {"alertname": "CDC Spark Processor Not Running"}}]}),),
    ]
    found = alerts.webhook_alerts(spark.createDataFrame(bodies, "body string"))
    rows = {r.error_type: r for r in alerts.normalised_webhook(found).collect()}
    assert set(rows) == {"kafka_broker_down", "freshness_sla_breach", "spark_not_running"}
    broker = rows["kafka_broker_down"]
    assert (broker.event_action, broker.severity, broker.table, broker.group, broker.component, broker.summary) == (
        "trigger", "error", "all", "infrastructure", "", "CDC Kafka Broker Unreachable")
    assert rows["freshness_sla_breach"].event_action == "resolve" and rows["freshness_sla_breach"].table == "orders"
    # No status means firing.
    assert rows["spark_not_running"].event_action == "trigger"
    assert {(r.alert_title, r.alerts) for r in alerts.unknown_titles(found).collect()} == {("New rule", 1), ("", 1)}


def test_bad_messages_go_to_the_reject_frame(spark):
    rows = [("t", '{"event_action":"trigger","error_type":"null_pk"}'), ("t", "{broken"), ("t", None),
            ("t", '{"event_action":"trigger","custom_details":{"a":1}}')]
    events, rejects = alerts.parse_events(spark.createDataFrame(rows, "topic string, value string"))
    assert rejects.count() == 2
    assert {r.custom_details for r in events.collect()} == {None, '{"a":1}'}


EVENTS = ("topic string, event_action string, dedup_key string, table string, error_type string, severity string, "
          "summary string, source string, component string, group string, custom_details string")


def test_outbound_bodies(spark):
    rows = [
        (fv.INFRA_TOPIC, "trigger", "", None, "kafka_broker_down", "error", None, None, None, None, None),
        (fv.DQ_TOPIC, "resolve", "own", "orders", "null_pk", None, None, None, None, None, None),
        (fv.DQ_TOPIC, None, None, "orders", None, None, "hello", None, None, None, None),
        (fv.DQ_TOPIC, "snooze", None, "orders", "null_pk", None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, EVENTS)
    got = alerts.outbound(df, {fv.INFRA_TOPIC: "k1", fv.DQ_TOPIC: ""}).collect()
    assert len(got) == 3
    first = json.loads(got[0]["body"])
    assert first["routing_key"] == "k1" and first["dedup_key"] == "cdc-all-kafka_broker_down"
    assert first["payload"]["severity"] == "critical" and first["payload"]["summary"] == "[CDC] kafka_broker_down on all"
    assert got[1]["dry_run"] and "payload" not in json.loads(got[1]["body"])
    assert json.loads(got[2]["body"])["event_action"] == "trigger"
    # The base key serves topics without one of their own.
    keyed = alerts.outbound(df, {fv.INFRA_TOPIC: "k1"}, "base").collect()
    assert [json.loads(r["body"])["routing_key"] for r in keyed] == ["k1", "base", "base"]
    graded = alerts.graded_for_delivery(df).first()
    assert (graded.payload_severity, graded.routed_severity) == ("error", "critical")


def test_freshness_events(spark):
    now = 10_000_000
    df = spark.createDataFrame([("a", now - 900_000), ("b", now - 900_001), ("c", None)], "table string, last_processed_ts_ms long")
    got = {r.table: r for r in alerts.freshness_events(df, now).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].event_action == "resolve" and got["b"].event_action == "trigger"
    assert got["b"].summary == "[CDC Freshness] 'b' data is 15.0 min stale (threshold: 15 min)"


def test_crash_events_and_topics(spark):
    df = spark.createDataFrame([("a", "crashed", None, "KeyError", "boom", 2, 5), ("b", "ok", None, None, None, 0, 5)],
                               "table string, status string, failed_step string, exception string, message string, "
                               "consecutive_failures int, ts_ms long")
    got = alerts.crash_events(df).withColumn("topic", alerts.topic_of(F.col("group"))).collect()
    assert [(r.summary, r.topic) for r in got] == [
        ("[CDC Pipeline] 'a' crashed at step unknown: KeyError", fv.INFRA_TOPIC)]


def test_retention(spark):
    day = 86_400_000
    df = spark.range(10).selectExpr(f"id * {day} as ts_ms")
    assert alerts.retained(df, 9 * day).count() == 8


def test_incident_cases(spark):
    rows = [("a", "resolve", 1, 0), ("a", "trigger", 2, 0), ("a", "trigger", 3, 0), ("a", "resolve", 4, 0),
            ("b", "trigger", 5, 0), ("b", "resolve", 5, 1), ("b", "trigger", 5, 2)]
    df = spark.createDataFrame(rows, "dedup_key string, event_action string, ts_ms long, seq long")
    pairs = alerts.incidents(df)
    got = {(r.dedup_key, r.opened_ms, r.resolved_ms, r.triggers) for r in pairs.collect()}
    assert got == {("a", 2, 4, 2), ("b", 5, 5, 1), ("b", 5, None, 1)}
    total = alerts.incident_summary(pairs, ["dedup_key"]).where("dedup_key = 'b'").first()
    assert (total.incidents, total.open_incidents) == (2, 1)


def test_failure_counts_since_success(spark):
    names = [c.split()[0] for c in OUTCOME_SCHEMA.split(", ")]
    log = [("a", "gate_failed", 1), ("a", "ok", 2), ("a", "crashed", 3), ("a", "no_new_events", 4),
           ("a", "unreadable", 5), ("b", "crashed", 1), ("c", "ok", 1)]
    data = [tuple({"table": t, "status": s, "ts_ms": m}.get(n) for n in names) for t, s, m in log]
    df = spark.createDataFrame(data, OUTCOME_SCHEMA)
    assert {tuple(r) for r in failure_counts(df).collect()} == {("a", 2), ("b", 1)}


def test_details_travel_as_objects(spark):
    events = spark.createDataFrame(
        [("trigger", "k", "s", "error", "t", "null_pk", "g", "c", "spark-cdc", "x", d, "dq") for d in ('{"a":{"b":[1,2]}}', "plain", None)],
        "event_action string, dedup_key string, summary string, severity string, table string, error_type string, "
        "group string, component string, source string, timestamp string, custom_details string, topic string",
    )
    sent = [json.loads(r["value"])["custom_details"] for r in alerts.as_messages(events, alerts.TRIGGER_FIELDS).collect()]
    assert sent == [{"a": {"b": [1, 2]}}, "plain", {}]
    bodies = [json.loads(r["body"])["payload"]["custom_details"] for r in alerts.outbound(events, {}).collect()]
    assert bodies == sent


def test_webhook_and_sample_files(spark, folder):
    from rillmark.sources import messages

    body = {"alerts": [{"status": "firing", "labels": {"alertname": "x"}, "annotations": {}}]}
    spark.createDataFrame([(json.dumps(body),)], "value string").write.text(folder + "/hooks")
    assert json.loads(messages.webhook_bodies(spark, folder + "/hooks").first()["body"]) == body
    spark.createDataFrame([("m", {"a": "b"}, 5, 1.5)], messages.SAMPLE_SCHEMA).write.parquet(folder + "/samples")
    assert tuple(messages.metric_samples(spark, folder + "/samples").first()) == ("m", {"a": "b"}, 5, 1.5)
