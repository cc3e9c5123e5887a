"""Table schemas and closed catalogs."""

from __future__ import annotations

from pyspark.sql import types as T

# The closed catalogs that messages are checked against.
BANKS = [
    "banco-central-datalandia",
    "banco-norte-metropolitano",
    "banco-sur-cooperativo",
    "banco-este-comercial",
    "banco-oeste-industrial",
    "banco-union-popular",
    "banco-progreso-digital",
    "banco-herencia-nacional",
    "banco-innovacion-fintech",
    "banco-solidario-regional",
    "banco-mercantil-datalandia",
    "banco-federal-integrado",
]
TRANSACTION_TYPES = ["TRANSFER", "PAYMENT", "WITHDRAWAL", "DEPOSIT"]
CHANNELS = ["APP", "ATM", "BRANCH", "CORRESPONDENT"]
CURRENCIES = ["DLD", "USD", "EUR"]
REQUIRED_FIELDS = ["bank_entity", "customer_id", "transaction_type", "amount", "currency", "channel"]
INFLOW_TYPES = ["DEPOSIT", "TRANSFER_IN"]
PAYDAYS = [1, 15, 30]
KPI_NAMES = ["TPS", "avg_latency", "fraud_rate", "approval_rate"]

# The texts a rejected message is answered with.
MSG_MISSING = "Campo requerido faltante: "
MSG_BANK = "Entidad bancaria inválida: "
MSG_TYPE = "Tipo de transacción inválido: "
MSG_CHANNEL = "Canal inválido: "
MSG_NOT_POSITIVE = "El monto debe ser positivo"
MSG_AMOUNT = "Monto inválido"
MSG_EMPTY_BODY = "Request body vacío"
MSG_NO_LOT = "Campo 'transactions' requerido"


# The declared columns of each table, and the type of an amount.
AMOUNT = "decimal(38,9)"


REQUIRED = False  # as Spark's ``nullable``


def _table(*columns: tuple) -> T.StructType:
    out = T.StructType()
    for column in columns:
        out.add(*column)
    return out


HISTORY = _table(
    ("transaction_id", "string", REQUIRED), ("bank_entity", "string", REQUIRED), ("customer_id", "string", REQUIRED),
    ("transaction_type", "string", REQUIRED), ("amount", "double", REQUIRED), ("currency", "string", REQUIRED),
    ("source_account", "string"), ("destination_account", "string"), ("destination_bank", "string"),
    ("channel", "string", REQUIRED), ("status", "string", REQUIRED), ("fraud_score", "double"),
    ("latitude", "double"), ("longitude", "double"), ("transaction_timestamp", "timestamp", REQUIRED),
    ("branch_id", "string"), ("is_fraud", "integer"),
)
TRANSACTIONS = _table(
    ("transaction_id", "string", REQUIRED), ("bank_entity", "string", REQUIRED), ("customer_id", "string", REQUIRED),
    ("transaction_type", "string", REQUIRED), ("amount", "decimal(38,9)", REQUIRED),
    ("currency", "string", REQUIRED), ("source_account", "string"), ("destination_account", "string"),
    ("destination_bank", "string"), ("channel", "string", REQUIRED), ("status", "string", REQUIRED),
    ("fraud_score", "double"), ("latitude", "double"), ("longitude", "double"), ("device_id", "string"),
    ("transaction_timestamp", "timestamp", REQUIRED), ("processing_timestamp", "timestamp", REQUIRED),
    ("metadata", "string"),
)
KPIS_REALTIME = _table(
    ("kpi_id", "string", REQUIRED), ("bank_entity", "string", REQUIRED), ("kpi_name", "string", REQUIRED),
    ("kpi_value", "double", REQUIRED), ("window_start", "timestamp", REQUIRED),
    ("window_end", "timestamp", REQUIRED), ("dimensions", "string"),
)
REPORTS = _table(
    ("report_id", "string", REQUIRED), ("report_type", "string", REQUIRED), ("bank_entity", "string", REQUIRED),
    ("report_date", "timestamp", REQUIRED), ("total_transactions", "long"), ("total_amount", "decimal(38,9)"),
    ("fraud_blocked_count", "long"), ("fraud_blocked_amount", "decimal(38,9)"), ("avg_processing_time_ms", "double"),
    ("details", "string"),
)
DATA_PRODUCTS = _table(
    ("product_id", "string", REQUIRED), ("product_name", "string", REQUIRED), ("customer_id", "string", REQUIRED),
    ("bank_entity", "string", REQUIRED), ("recommendation_score", "double"), ("product_type", "string", REQUIRED),
    ("generated_at", "timestamp", REQUIRED), ("features", "string"),
)
LIQUIDITY_FORECAST = _table(
    ("forecast_id", "string", REQUIRED), ("bank_entity", "string", REQUIRED),
    ("forecast_date", "timestamp", REQUIRED), ("predicted_inflow", "decimal(38,9)", REQUIRED),
    ("predicted_outflow", "decimal(38,9)", REQUIRED), ("net_liquidity", "decimal(38,9)", REQUIRED),
    ("confidence_interval_lower", "decimal(38,9)"), ("confidence_interval_upper", "decimal(38,9)"),
    ("model_version", "string"), ("is_holiday", "boolean"), ("is_payday", "boolean"),
)
INTEREST_RATES = _table(
    ("rate_id", "string", REQUIRED), ("country_code", "string", REQUIRED), ("rate_type", "string", REQUIRED),
    ("rate_value", "double", REQUIRED), ("effective_date", "date", REQUIRED), ("source", "string"),
)
EXCHANGE_RATES = _table(
    ("pair_id", "string", REQUIRED), ("base_currency", "string", REQUIRED), ("quote_currency", "string", REQUIRED),
    ("rate", "double", REQUIRED), ("timestamp", "timestamp", REQUIRED), ("source", "string"),
)
BRANCH_VOLUME_METRICS = _table(
    ("metric_id", "string", REQUIRED), ("bank_entity", "string", REQUIRED), ("branch_id", "string", REQUIRED),
    ("channel_type", "string", REQUIRED), ("metric_date", "timestamp", REQUIRED),
    ("total_transactions", "long", REQUIRED), ("total_amount", "decimal(38,9)", REQUIRED),
    ("avg_wait_time_minutes", "double"), ("utilization_rate", "double"), ("peak_hour", "long"),
)
WAREHOUSE = {
    "transactions": TRANSACTIONS, "kpis_realtime": KPIS_REALTIME, "reports": REPORTS,
    "data_products": DATA_PRODUCTS, "liquidity_forecast": LIQUIDITY_FORECAST,
    "interest_rates": INTEREST_RATES, "exchange_rates": EXCHANGE_RATES,
    "branch_volume_metrics": BRANCH_VOLUME_METRICS,
}

DAILY_CLOSE = T.StructType([
    T.StructField("bank_entity", T.StringType()),
    T.StructField("extraction_date", T.TimestampType()),
    T.StructField("execution_id", T.StringType()),
    T.StructField("records_type", T.StringType()),
    T.StructField("accounts_summary", T.StructType([
        T.StructField("total_accounts", T.LongType()),
        T.StructField("active_accounts", T.LongType()),
        T.StructField("total_balance", T.DoubleType()),
    ])),
    T.StructField("transactions_summary", T.StructType([
        T.StructField("total_count", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
    ])),
])

# Batch feeds.  Only their names and cadence are given by the business, so the
# columns below are this build's own reading of each feed.
FEEDS = {
    "clients": ("csv", _table(
    ("customer_id", "string", REQUIRED), ("name", "string"), ("segment", "string"), ("country", "string"),
    ("balance", "double"),
)),
    "accounts": ("csv", _table(
    ("account_id", "string", REQUIRED), ("customer_id", "string", REQUIRED), ("bank_entity", "string", REQUIRED),
    ("balance", "double"), ("opened", "date"),
)),
    "transactions": ("jdbc", HISTORY),
    "closures": ("json", DAILY_CLOSE),
    "rates": ("json", INTEREST_RATES),
    "atm_events": ("json", _table(
    ("event_id", "string", REQUIRED), ("bank_entity", "string", REQUIRED), ("branch_id", "string"),
    ("event_type", "string"), ("event_ts", "timestamp", REQUIRED), ("amount", "double"),
)),
    "fx": ("json", EXCHANGE_RATES),
    "indicators": ("parquet", _table(
    ("indicator", "string", REQUIRED), ("country_code", "string"), ("period", "date"), ("value", "double"),
)),
    "search_trends": ("json", _table(("term", "string", REQUIRED), ("region", "string"), ("trend_date", "date"), ("score", "double"))),
    "calendar": ("csv", _table(("date", "date", REQUIRED), ("event", "string"), ("is_holiday", "boolean"))),
}
