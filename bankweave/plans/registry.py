"""Registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Named subqueries the checks build on: the test tables as transactions and companions.
_SCORE = "((((c1 % 100) * 96 + c2 % 100) % 100 * 96 + c3 % 100) % 100 * 96 + c4 % 100) % 100"


def _score_of(source: str, key: str) -> str:
    chunks = ", ".join(f"CAST('0x' || substr(md5({key}), {1 + 8 * i}, 8) AS BIGINT) AS c{i + 1}" for i in range(4))
    return (
        f"SELECT * EXCLUDE (c1, c2, c3, c4, score_100), score_100::DOUBLE / 100 AS fraud_score, "
        f"CASE WHEN score_100::DOUBLE / 100 > 0.85 THEN 'BLOCKED' WHEN score_100::DOUBLE / 100 > 0.7 THEN 'PENDING' "
        f"ELSE 'APPROVED' END AS status FROM (SELECT *, {_SCORE} AS score_100 FROM (SELECT *, {chunks} FROM {source}))"
    )


CTES: dict[str, tuple[str, str]] = {
    "ev": ("", "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"),
    "tx0": ("ev", """
        SELECT event_id, 'T' || event_id AS transaction_id, 'bank-' || lpad(CAST(k % 12 AS VARCHAR), 2, '0') AS bank_entity,
          'CLI-' || user_id AS customer_id,
          CASE event_type WHEN 'click' THEN 'TRANSFER' WHEN 'view' THEN 'PAYMENT' WHEN 'purchase' THEN 'WITHDRAWAL'
            WHEN 'signup' THEN 'DEPOSIT' ELSE 'ERROR' END AS transaction_type,
          value AS amount, CASE event_id % 3 WHEN 0 THEN 'DLD' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency,
          'BAN-' || user_id AS source_account, 'BAN-' || event_id AS destination_account,
          'bank-' || lpad(CAST((k + 5) % 12 AS VARCHAR), 2, '0') AS destination_bank,
          CASE event_id % 4 WHEN 0 THEN 'APP' WHEN 1 THEN 'ATM' WHEN 2 THEN 'BRANCH' ELSE 'CORRESPONDENT' END AS channel,
          4.5::DOUBLE + (event_id % 6500)::DOUBLE / 1000 AS latitude, (-75)::DOUBLE + (event_id % 8000)::DOUBLE / 1000 AS longitude,
          CASE WHEN event_id % 4 = 0 THEN 'DEV-' || user_id END AS device_id,
          ts AS transaction_timestamp, ts + to_milliseconds(event_id % 500) AS processing_timestamp,
          CASE WHEN event_id % 4 <> 0 THEN 'SUC-' || lpad(CAST(user_id % 50 AS VARCHAR), 3, '0') END AS branch_id,
          CASE WHEN event_id % 4 = 0 AND value >= 60 THEN 1 ELSE 0 END AS is_fraud
        FROM ev"""),
    "tx_all": ("tx0", _score_of("tx0", "transaction_id")),
    "tx": ("tx_all", "SELECT *, CAST(amount AS DECIMAL(38,9)) AS cents, CAST(transaction_timestamp AS DATE) AS d FROM tx_all WHERE transaction_type <> 'ERROR'"),
    "li0": ("", """
        SELECT l_orderkey || '-' || l_linenumber AS transaction_id, 'bank-' || lpad(CAST(l_suppkey % 12 AS VARCHAR), 2, '0') AS bank_entity,
          'CLI-' || l_partkey AS customer_id,
          CASE l_linenumber % 4 WHEN 0 THEN 'TRANSFER' WHEN 1 THEN 'PAYMENT' WHEN 2 THEN 'WITHDRAWAL' ELSE 'DEPOSIT' END AS transaction_type,
          l_extendedprice AS amount,
          CASE l_partkey % 4 WHEN 0 THEN 'APP' WHEN 1 THEN 'ATM' WHEN 2 THEN 'BRANCH' ELSE 'CORRESPONDENT' END AS channel,
          l_shipdate AS transaction_timestamp,
          CASE WHEN l_partkey % 4 <> 0 THEN 'SUC-' || lpad(CAST(l_suppkey % 50 AS VARCHAR), 3, '0') END AS branch_id FROM lineitem"""),
    "li": ("li0", f"SELECT *, CAST(amount AS DECIMAL(38,9)) AS cents, CAST(transaction_timestamp AS DATE) AS d FROM ({_score_of('li0', 'transaction_id')})"),
    "fx": ("ev", """
        SELECT 'P' || event_id AS pair_id, CASE event_id % 3 WHEN 0 THEN 'DLD' WHEN 1 THEN 'USD' ELSE 'EUR' END AS base_currency,
          'DLD' AS quote_currency, round(1 + value / 1000, 5) AS rate, ts AS "timestamp", 'feed' AS source
        FROM ev WHERE event_type = 'error'"""),
    "prof": ("", """
        SELECT 'CLI-' || c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance, n_name AS country_code
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "cal": ("", """
        SELECT dd AS date, CAST(dd AS VARCHAR) IN ('2024-01-01', '2024-01-08') AS is_holiday, day(dd) IN (1, 15, 30) AS is_payday,
          dayofweek(dd) IN (0, 6) AS is_weekend, dayofweek(dd) + 1 AS day_of_week
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dd FROM
          (SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS lo, CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) + INTERVAL 30 DAY AS hi FROM events))"""),
    "rates": ("", """
        SELECT 'R-' || n_nationkey || '-' || m AS rate_id, n_name AS country_code,
          CASE n_nationkey % 4 WHEN 0 THEN 'LENDING' WHEN 1 THEN 'SAVINGS' WHEN 2 THEN 'MORTGAGE' ELSE 'INTERBANK' END AS rate_type,
          0.02::DOUBLE + ((n_nationkey * 7 + m) % 50)::DOUBLE / 1000 AS rate_value,
          CAST(DATE '2024-01-01' + CAST(m * 10 AS INTEGER) AS DATE) AS effective_date, 'central' AS source
        FROM nation, (VALUES (0), (1), (2)) t(m)"""),
    "liq": ("tx", """
        SELECT bank_entity, d AS date, sum(CASE WHEN transaction_type = 'DEPOSIT' THEN cents ELSE 0 END)::DOUBLE AS total_inflow,
          sum(CASE WHEN transaction_type <> 'DEPOSIT' THEN cents ELSE 0 END)::DOUBLE AS total_outflow,
          sum(CASE WHEN transaction_type = 'DEPOSIT' THEN cents ELSE -cents END)::DOUBLE AS net_liquidity,
          dayofweek(d) + 1 AS day_of_week, day(d) AS day_of_month, day(d) IN (1, 15, 30) AS is_payday
        FROM tx GROUP BY bank_entity, d"""),
    "kpi": ("tx", """
        SELECT date_trunc('hour', transaction_timestamp) AS window_start, date_trunc('hour', transaction_timestamp) + INTERVAL 1 HOUR AS window_end,
          bank_entity, count(*) AS n, sum(event_id % 500)::BIGINT AS latency_ms, count(*) FILTER (status = 'BLOCKED') AS blocked,
          count(*) FILTER (status = 'APPROVED') AS approved FROM tx GROUP BY ALL"""),
    "kpis": ("kpi", """
        SELECT bank_entity, window_start, window_end, kpi_name, kpi_value, '{"transactions":' || n || '}' AS dimensions,
          sha256(bank_entity || '|' || kpi_name || '|' || epoch_us(window_start)) AS kpi_id FROM (
          SELECT *, unnest(['TPS', 'avg_latency', 'fraud_rate', 'approval_rate']) AS kpi_name,
            unnest([n::DOUBLE / 3600, latency_ms::DOUBLE / n, blocked::DOUBLE / n, approved::DOUBLE / n]) AS kpi_value FROM kpi)"""),
    "hours": ("tx", """
        SELECT bank_entity, branch_id, channel, d, hour(transaction_timestamp) AS h, count(*) AS n FROM tx
        WHERE branch_id IS NOT NULL GROUP BY ALL"""),
    "branch": ("hours", """
        SELECT t.bank_entity, t.branch_id, t.channel AS channel_type, t.d AS metric_date, count(*) AS total_transactions,
          sum(t.cents)::DOUBLE AS total_amount, quantile_disc(t.amount, 0.5) AS median_amount,
          max(hour(t.transaction_timestamp)) AS last_active_hour, any_value(p.h) AS peak_hour
        FROM tx t JOIN (SELECT * FROM hours QUALIFY row_number() OVER (PARTITION BY bank_entity, branch_id, channel, d ORDER BY n DESC, h) = 1) p
          ON t.bank_entity = p.bank_entity AND t.branch_id = p.branch_id AND t.channel = p.channel AND t.d = p.d
        GROUP BY t.bank_entity, t.branch_id, t.channel, t.d"""),
    "util": ("branch", """
        SELECT bank_entity, metric_date, branch_id, n AS branch_transactions,
          n::DOUBLE / max(n) OVER (PARTITION BY bank_entity, metric_date) AS utilization_rate
        FROM (SELECT bank_entity, metric_date, branch_id, sum(total_transactions)::BIGINT AS n FROM branch GROUP BY ALL)"""),
    "kinds": ("tx", "SELECT bank_entity, d, transaction_type, count(*) AS n FROM tx GROUP BY ALL"),
    "act": ("tx", """
        SELECT customer_id, bank_entity, count(*) AS n, count(*) FILTER (status = 'BLOCKED') AS blocked,
          min(transaction_timestamp) FILTER (status = 'BLOCKED') AS first_blocked_ts FROM tx GROUP BY ALL"""),
    # Expected outcome of every message variant, and with what the warehouse cannot hold as ``faults``.
    "fate": ("msg", """
        SELECT *, CASE WHEN len(errors) > 0 THEN array_to_string(errors, '; ') WHEN v = 27 THEN 'null customer_id'
          WHEN v = 28 THEN 'null transaction_timestamp' WHEN v = 30 THEN 'amount out of range' END AS faults FROM msg"""),
    "msg": ("tx_all", """
        SELECT * REPLACE (CASE WHEN v <> 27 THEN customer_id END AS customer_id,
            CASE v WHEN 28 THEN NULL WHEN 29 THEN TIMESTAMP '2099-01-01' ELSE transaction_timestamp END AS transaction_timestamp),
          v IN (11, 12, 13) AS malformed,
          CASE WHEN v IN (11, 12, 13) THEN ['malformed']
            WHEN v = 0 THEN ['Campo requerido faltante: currency']
            WHEN v = 1 THEN ['Campo requerido faltante: amount', 'Campo requerido faltante: currency', 'Campo requerido faltante: channel']
            WHEN v = 14 THEN ['Campo requerido faltante: bank_entity', 'Campo requerido faltante: customer_id',
              'Campo requerido faltante: transaction_type', 'Campo requerido faltante: amount',
              'Campo requerido faltante: currency', 'Campo requerido faltante: channel']
            ELSE list_filter([
              CASE v WHEN 2 THEN 'Entidad bancaria inválida: bank-99' WHEN 10 THEN 'Entidad bancaria inválida: ["' || bank_entity || '"]' END,
              CASE WHEN transaction_type = 'ERROR' THEN 'Tipo de transacción inválido: ERROR' END,
              CASE WHEN v = 2 THEN 'Canal inválido: FAX' END,
              CASE WHEN v IN (3, 4) THEN 'El monto debe ser positivo' WHEN v IN (6, 7, 8, 9, 19, 20) THEN 'Monto inválido' END
            ], lambda e: e IS NOT NULL) END AS errors,
          CASE v WHEN 18 THEN 1000.0::DOUBLE WHEN 22 THEN 1e17::DOUBLE WHEN 23 THEN 12.345678::DOUBLE WHEN 30 THEN 1e30::DOUBLE ELSE amount END AS parsed_amount
        FROM (SELECT *, event_id % 40 AS v FROM tx_all)"""),
}


def sql(uses: str, body: str) -> str:
    """Check query over the named subqueries it uses."""
    order: list[str] = []

    def add(name: str) -> None:
        for dep in CTES[name][0].split():
            add(dep)
        if name not in order:
            order.append(name)

    for name in uses.split():
        add(name)
    parts = ", ".join(f"{n} AS ({CTES[n][1].strip()})" for n in order)
    return f"WITH {parts} {body.strip()}" if parts else body.strip()


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so that a result reads the same wherever it is collected."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain(fn(spark, sf_dir))

        QUERIES[name] = run
        if check is not None:
            ORACLES[name] = check
        return run

    return register
