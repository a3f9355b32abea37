"""Names, codes, limits and lookup tables that results depend on.

Everything here is data. Logic lives in the operator modules.
"""

# --- change feed -----------------------------------------------------------
# Operation codes of a change envelope (create, update, snapshot
# read, delete) and the ones that carry a row to store.
OP_CREATE = "c"
OP_UPDATE = "u"
OP_SNAPSHOT = "r"
OP_DELETE = "d"
STORED_OPS = ("c", "u", "r")

# Three-part topic names keep their third part.
TOPIC_ROUTE_REGEX = r"([^.]+)\.([^.]+)\.([^.]+)"
TOPIC_ROUTE_REPLACEMENT = "$3"

# Landing files hold at most 50 records and rotate every 60 s.
LANDING_RECORDS_PER_FILE = 50
LANDING_TRIGGER = "60 seconds"

# Names of the columns added to a stored row.
CDC_TS = "cdc_ts_ms"
CDC_OP = "cdc_op"
DATE_PARTITIONS = ("year", "month", "day")
# Ours: the column that says which micro-batch stored a row.
BATCH_COL = "batch_id"

# --- limits ----------------------------------------------------------------
FRESHNESS_LIMIT_S = 900
PK_CRITICAL_RATIO = 0.5
OP_WARNING_RATIO = 0.01
ALERT_RETENTION_DAYS = 7
RECENT_RUN_S = 600
# Ours: how far back a run looks for a table's last outcome.
OUTCOME_DAYS = 30

# --- alert events ----------------------------------------------------------
ALERT_SOURCE = "spark-cdc"
DEFAULT_SEVERITY = ("SEV-2", "error")
UNKNOWN_SEV_LABEL = "SEV-?"

# Error type -> (label, severity) used at delivery.
DELIVERY_SEVERITY = {
    "spark_not_running": ("SEV-1", "critical"),
    "kafka_broker_down": ("SEV-1", "critical"),
    "kafka_lag_growing": ("SEV-2", "error"),
    "freshness_sla_breach": ("SEV-2", "error"),
    "duplicate_pk": ("SEV-2", "error"),
    "null_pk": ("SEV-2", "error"),
    "empty_table": ("SEV-2", "error"),
    "invalid_cdc_op": ("SEV-2", "error"),
    "stale_data": ("SEV-3", "warning"),
}

# Ours: a crash is sent as critical, so it is delivered as critical too
# (without this entry it would fall to the default).
DELIVERY_SEVERITY_EXTENDED = {
    **DELIVERY_SEVERITY,
    "unhandled_exception": ("SEV-1", "critical"),
}

# Rule title -> error type for webhook bodies.
TITLE_TO_ERROR_TYPE = {
    "CDC Kafka Consumer Lag Too High": "kafka_lag_growing",
    "CDC Spark Processor Not Running": "spark_not_running",
    "CDC Data Freshness SLA Breach": "freshness_sla_breach",
    "CDC Kafka Broker Unreachable": "kafka_broker_down",
}

# Titles and title prefixes that a webhook body may hold and that
# are dropped without a report (red, orange, yellow and blue circle).
SKIPPED_TITLES = ("DatasourceNoData", "DatasourceError", "DatasourceNoData resolved")
SKIPPED_PREFIXES = ("\U0001f534", "\U0001f7e0", "\U0001f7e1", "\U0001f535")

# Texts of check results and alert summaries (printf formats).
ALL_PASSED = "all constraints passed"
NO_ROWS = "table has 0 rows"
NOT_EVALUATED = "no rows to evaluate"
NO_DETAIL = "no detail"
UNMET = "Value: %s does not meet the constraint requirement!"
AGE_TEXT = "latest event is %.1f seconds old (threshold: {limit} seconds)"
DQ_SUMMARY = "[CDC DQ %s] '%s': %s FAILED — %s rows (%s) | %s"
DQ_EMPTY_SUMMARY = "[CDC DQ %s] '%s': %s FAILED — %s"
CRASH_SUMMARY = "[CDC Pipeline] '%s' crashed at step %s: %s"
FRESHNESS_SUMMARY = "[CDC Freshness] '%s' data is %.1f min stale (threshold: {limit:.0f} min)"
PLAIN_SUMMARY = "[CDC] %s on %s"

# Topic names are deployment settings; these are our defaults.
INFRA_TOPIC = "alerts.infrastructure"
DQ_TOPIC = "alerts.data-quality"

# Notification grouping.
GROUP_BY = ("alertname", "table")
GROUP_WAIT_MS = 30_000
GROUP_INTERVAL_MS = 300_000
REPEAT_INTERVAL_MS = 4 * 3_600_000

# --- metrics ---------------------------------------------------------------
# Gauges written by a run.
GAUGES = (
    "cdc_rows_written_total",
    "cdc_processing_duration_seconds",
    "cdc_last_run_timestamp_seconds",
    "cdc_dq_check_status",
    "cdc_rows_read_total",
    "cdc_dq_last_run_timestamp_seconds",
    "cdc_freshness_gap_seconds",
    "cdc_consecutive_failures_total",
)

# Bean pattern -> (metric name, type). Names come out lower-case;
# the first capture group becomes the label `connector`.
JMX_BEAN_PREFIX = (
    r"debezium\.postgres<type=connector-metrics, context=streaming, server=([^,]+)><>"
)
JMX_RULES = (
    ("MilliSecondsBehindSource", "debezium_metrics_millisecondsbehindource", "gauge"),
    ("TotalNumberOfEventsSeen", "debezium_metrics_totalnumberofeventsseen_total", "counter"),
    ("Connected", "debezium_metrics_connected", "gauge"),
)

LOOKBACK_MS = 300_000
RULE_RANGE_MS = 600_000
RULE_STEP_MS = 60_000

# Panel bands as (lower bound, colour), lowest first; None = no
# lower bound.
BANDS = {
    "spark_status": ((None, "green"), (120.0, "yellow"), (600.0, "red")),
    "kafka_broker": ((None, "red"), (1.0, "green")),
    "sink_lag": ((None, "green"), (100.0, "yellow"), (1000.0, "red")),
    "dq_pass_rate": ((None, "red"), (0.5, "yellow"), (1.0, "green")),
    "freshness_gap": ((None, "green"), (300.0, "yellow"), (900.0, "red")),
    "pass_through": ((None, "red"), (0.8, "yellow"), (0.95, "green")),
}
NO_DATA_TEXT = {
    "spark_status": "No Data / DOWN",
    "kafka_broker": "No Data / DOWN",
    "dq_pass_rate": "No Data / Spark DOWN",
}

# --- replicated tables -----------------------------------------------------
# Tables that are replicated into bronze, their keys and types.
REPLICATED = {
    "orders": (
        ("order_id",),
        "order_id SMALLINT, customer_id STRING, employee_id SMALLINT, order_date DATE, "
        "required_date DATE, shipped_date DATE, ship_via SMALLINT, freight FLOAT, "
        "ship_name STRING, ship_address STRING, ship_city STRING, ship_region STRING, "
        "ship_postal_code STRING, ship_country STRING",
    ),
    "order_details": (
        ("order_id", "product_id"),
        "order_id SMALLINT, product_id SMALLINT, unit_price FLOAT, quantity SMALLINT, "
        "discount FLOAT",
    ),
    "products": (
        ("product_id",),
        "product_id SMALLINT, product_name STRING, supplier_id SMALLINT, category_id SMALLINT, "
        "quantity_per_unit STRING, unit_price FLOAT, units_in_stock SMALLINT, "
        "units_on_order SMALLINT, reorder_level SMALLINT, discontinued INT",
    ),
}

# Source tables as (primary key, DDL). NOT NULL and VARCHAR(n)
# are the source's constraints; the checks in operators.integrity read them.
SOURCE_TABLES = {
    "categories": (
        ("category_id",),
        "category_id SMALLINT NOT NULL, category_name VARCHAR(15) NOT NULL, "
        "description STRING, picture BINARY",
    ),
    "customer_customer_demo": (
        ("customer_id", "customer_type_id"),
        "customer_id VARCHAR(5) NOT NULL, customer_type_id VARCHAR(5) NOT NULL",
    ),
    "customer_demographics": (
        ("customer_type_id",),
        "customer_type_id VARCHAR(5) NOT NULL, customer_desc STRING",
    ),
    "customers": (
        ("customer_id",),
        "customer_id VARCHAR(5) NOT NULL, company_name VARCHAR(40) NOT NULL, "
        "contact_name VARCHAR(30), contact_title VARCHAR(30), address VARCHAR(60), "
        "city VARCHAR(15), region VARCHAR(15), postal_code VARCHAR(10), country VARCHAR(15), "
        "phone VARCHAR(24), fax VARCHAR(24)",
    ),
    "employees": (
        ("employee_id",),
        "employee_id SMALLINT NOT NULL, last_name VARCHAR(20) NOT NULL, "
        "first_name VARCHAR(10) NOT NULL, title VARCHAR(30), title_of_courtesy VARCHAR(25), "
        "birth_date DATE, hire_date DATE, address VARCHAR(60), city VARCHAR(15), "
        "region VARCHAR(15), postal_code VARCHAR(10), country VARCHAR(15), "
        "home_phone VARCHAR(24), extension VARCHAR(4), photo BINARY, notes STRING, "
        "reports_to SMALLINT, photo_path VARCHAR(255)",
    ),
    "employee_territories": (
        ("employee_id", "territory_id"),
        "employee_id SMALLINT NOT NULL, territory_id VARCHAR(20) NOT NULL",
    ),
    "order_details": (
        ("order_id", "product_id"),
        "order_id SMALLINT NOT NULL, product_id SMALLINT NOT NULL, unit_price FLOAT NOT NULL, "
        "quantity SMALLINT NOT NULL, discount FLOAT NOT NULL",
    ),
    "orders": (
        ("order_id",),
        "order_id SMALLINT NOT NULL, customer_id VARCHAR(5), employee_id SMALLINT, "
        "order_date DATE, required_date DATE, shipped_date DATE, ship_via SMALLINT, "
        "freight FLOAT, ship_name VARCHAR(40), ship_address VARCHAR(60), "
        "ship_city VARCHAR(15), ship_region VARCHAR(15), ship_postal_code VARCHAR(10), "
        "ship_country VARCHAR(15)",
    ),
    "products": (
        ("product_id",),
        "product_id SMALLINT NOT NULL, product_name VARCHAR(40) NOT NULL, "
        "supplier_id SMALLINT, category_id SMALLINT, quantity_per_unit VARCHAR(20), "
        "unit_price FLOAT, units_in_stock SMALLINT, units_on_order SMALLINT, "
        "reorder_level SMALLINT, discontinued INT NOT NULL",
    ),
    "region": (
        ("region_id",),
        "region_id SMALLINT NOT NULL, region_description VARCHAR(60) NOT NULL",
    ),
    "shippers": (
        ("shipper_id",),
        "shipper_id SMALLINT NOT NULL, company_name VARCHAR(40) NOT NULL, phone VARCHAR(24)",
    ),
    "suppliers": (
        ("supplier_id",),
        "supplier_id SMALLINT NOT NULL, company_name VARCHAR(40) NOT NULL, "
        "contact_name VARCHAR(30), contact_title VARCHAR(30), address VARCHAR(60), "
        "city VARCHAR(15), region VARCHAR(15), postal_code VARCHAR(10), country VARCHAR(15), "
        "phone VARCHAR(24), fax VARCHAR(24), homepage STRING",
    ),
    "territories": (
        ("territory_id",),
        "territory_id VARCHAR(20) NOT NULL, territory_description VARCHAR(60) NOT NULL, "
        "region_id SMALLINT NOT NULL",
    ),
    "us_states": (
        ("state_id",),
        "state_id SMALLINT NOT NULL, state_name VARCHAR(100), state_abbr VARCHAR(2), "
        "state_region VARCHAR(50)",
    ),
}

# Foreign keys as (child, column, parent, parent column).
FOREIGN_KEYS = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "employee_id", "employees", "employee_id"),
    ("orders", "ship_via", "shippers", "shipper_id"),
    ("order_details", "product_id", "products", "product_id"),
    ("order_details", "order_id", "orders", "order_id"),
    ("products", "category_id", "categories", "category_id"),
    ("products", "supplier_id", "suppliers", "supplier_id"),
    ("territories", "region_id", "region", "region_id"),
    ("employee_territories", "territory_id", "territories", "territory_id"),
    ("employee_territories", "employee_id", "employees", "employee_id"),
    (
        "customer_customer_demo",
        "customer_type_id",
        "customer_demographics",
        "customer_type_id",
    ),
    ("customer_customer_demo", "customer_id", "customers", "customer_id"),
    ("employees", "reports_to", "employees", "employee_id"),
)
