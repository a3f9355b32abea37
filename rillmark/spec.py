"""Declarations that the operators take: tables, checks, foreign keys and rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import types as T

from rillmark import fixed_values as fv


@dataclass(frozen=True)
class TableSpec:
    """One replicated table: its key, its column types (DDL) and metadata columns."""

    name: str
    pk: tuple[str, ...]
    ddl: str
    ts_col: str = fv.CDC_TS
    op_col: str = fv.CDC_OP

    def schema(self) -> T.StructType:
        """Declared columns as a StructType (needs an active session)."""
        return T.StructType.fromDDL(self.ddl)

    def stored_schema(self) -> T.StructType:
        """Declared columns plus the change metadata that bronze keeps."""
        extra = [T.StructField(self.ts_col, T.LongType()), T.StructField(self.op_col, T.StringType())]
        return T.StructType(self.schema().fields + extra)

    def create_table_sql(self, database: str, location: str) -> str:
        """DDL of the external, date-partitioned bronze table."""
        parts = ", ".join(f"{c} INT" for c in fv.DATE_PARTITIONS)
        where = location.replace("'", "\\'")
        return (
            f"CREATE TABLE IF NOT EXISTS {database}.{self.name} "
            f"({self.ddl}, {self.ts_col} BIGINT, {self.op_col} STRING, {parts}) "
            f"USING PARQUET PARTITIONED BY ({', '.join(fv.DATE_PARTITIONS)}) "
            f"LOCATION '{where}'"
        )


@dataclass(frozen=True)
class ForeignKey:
    """`child.column` must be null or present in `parent.parent_column`."""

    child: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class CheckSpec:
    """A user check: an aggregate over the batch and a rule on its value.

    `metric` is an aggregate Column (for example ``F.avg("x")``), `passes` maps
    the metric Column to a boolean Column. Catalyst evaluates both.
    """

    name: str
    error_type: str
    metric: Column
    passes: Callable[[Column], Column]


@dataclass(frozen=True)
class Selector:
    """Picks series of one metric: exact label values and anchored label regexes."""

    metric: str
    equals: tuple[tuple[str, str], ...] = ()
    matches: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class RuleSpec:
    """A threshold rule over metric samples.

    `subject` says how a series value becomes the compared value: ``value`` as
    it is, ``age`` (evaluation time minus the value, in seconds) or ``ratio``
    (value divided by the `divisor` series with the same labels). `by` keeps
    only these labels and takes `fold` over the rest; None keeps all labels. A rule
    that cannot be evaluated takes `on_error`: `Error` (a state of its own),
    `Alerting` (a breach) or `OK`.
    """

    name: str
    selector: Selector
    compare: str
    threshold: float
    hold_ms: int
    subject: str = "value"
    divisor: Selector | None = None
    by: tuple[str, ...] | None = None
    fold: str = "max"
    no_data: str = "NoData"
    severity: str = "error"
    on_error: str = "Error"


def replicated_tables() -> dict[str, TableSpec]:
    """The tables replicated into bronze."""
    return {n: TableSpec(n, pk, ddl) for n, (pk, ddl) in fv.REPLICATED.items()}


def source_tables() -> dict[str, TableSpec]:
    """All source tables with their NOT NULL and length constraints."""
    return {n: TableSpec(n, pk, ddl) for n, (pk, ddl) in fv.SOURCE_TABLES.items()}


def source_foreign_keys() -> tuple[ForeignKey, ...]:
    return tuple(ForeignKey(*fk) for fk in fv.FOREIGN_KEYS)


def default_rules(connector: str, sink_group: str, worker: str) -> tuple[RuleSpec, ...]:
    """The eight standard rules; the three arguments are label values of a deployment."""
    lag = "kafka_consumergroup_lag"
    minute = 60_000
    # Rule subjects, thresholds and hold times.
    return (
        RuleSpec(
            "\U0001f534 SEV-1 (Critical)",
            Selector("debezium_metrics_millisecondsbehindource", (("connector", connector),)),
            "gt", 3.6e6, 0, severity="critical",
        ),
        RuleSpec(
            "\U0001f7e0 SEV-2 (High)", Selector(lag), "gt", 5000.0, 5 * minute,
            by=("topic",), severity="high",
        ),
        RuleSpec(
            "\U0001f7e1 SEV-3 (Moderate)",
            Selector("jvm_memory_bytes_used", (("area", "heap"),)),
            "gt", 0.85, 15 * minute, subject="ratio",
            divisor=Selector("jvm_memory_bytes_max", (("area", "heap"),)), severity="severity",
        ),
        RuleSpec(
            "\U0001f535 SEV-4 (Low)", Selector("up", (("instance", worker),)),
            "lt", 1.0, 0, severity="low",
        ),
        RuleSpec(
            "CDC Kafka Consumer Lag Too High", Selector(lag, (("consumergroup", sink_group),)),
            "gt", 1000.0, minute, by=("topic",), severity="critical",
        ),
        RuleSpec(
            "CDC Spark Processor Not Running",
            Selector("cdc_last_run_timestamp_seconds", matches=(("table", ".+"),)),
            "gt", 600.0, 2 * minute, subject="age", severity="critical",
        ),
        RuleSpec(
            "CDC Data Freshness SLA Breach",
            Selector("cdc_freshness_gap_seconds", matches=(("table", ".+"),)),
            "gt", 900.0, 2 * minute, severity="critical",
        ),
        # A reported value below 1 and a missing series both mean the broker is
        # gone; the missing series is the no-data leg.
        RuleSpec(
            "CDC Kafka Broker Unreachable", Selector("kafka_brokers"),
            "lt", 1.0, minute, no_data="Alerting", severity="critical",
        ),
    )
