"""Registered queries: aggregations, joins, windows, ordered pages and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from bankweave.functions import is_weekend, money, total
from bankweave.operators import aggregates as A
from bankweave.operators import joins as J
from bankweave.operators import predict as P
from bankweave.operators import tables as K
from bankweave.operators import windows as W
from bankweave.plans import jobs
from bankweave.plans.registry import query, sql
from bankweave.session import new_folder
from bankweave.sources import files
from bankweave.sources import fixtures as fx

TRENDS = """bank_entity, d AS date, count(*) AS total_transactions, sum(cents)::DOUBLE AS total_amount,
  count(DISTINCT customer_id) AS unique_customers, count(*) FILTER (status = 'APPROVED') AS approved_count,
  count(*) FILTER (status = 'BLOCKED') AS blocked_count, dayofweek(d) + 1 AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
  sum(cents)::DOUBLE / count(*) AS avg_amount, count(*) FILTER (status = 'APPROVED')::DOUBLE / count(*) AS approval_rate"""


@query("a1_movement_trends", sql("tx", f"SELECT {TRENDS} FROM tx GROUP BY bank_entity, d"))
def a1(spark, sf):
    return A.movement_trends(fx.tx(spark, sf))


@query("a1_movement_trends_long", sql("li", f"SELECT {TRENDS} FROM li GROUP BY bank_entity, d"))
def a1_long(spark, sf):
    return A.movement_trends(fx.tx_lineitem(spark, sf))


@query("a2_daily_liquidity", sql("liq", "SELECT * FROM liq"))
def a2(spark, sf):
    return A.daily_liquidity(fx.tx(spark, sf))


@query("a3_branch_metrics", sql("branch", "SELECT * FROM branch"))
def a3(spark, sf):
    return A.branch_metrics(fx.tx(spark, sf))


SUMMARY = """SELECT bank_entity, count(*) AS total_transactions, sum(cents)::DOUBLE AS total_amount,
  count(*) FILTER (status = 'APPROVED') AS approved, count(*) FILTER (status = 'BLOCKED') AS blocked,
  count(*) FILTER (status = 'PENDING') AS pending, sum(CAST(fraud_score AS DECIMAL(18,6)))::DOUBLE / count(*) AS avg_fraud_score,
  min(transaction_timestamp) AS first_txn, max(transaction_timestamp) AS last_txn, sum(cents)::DOUBLE / count(*) AS avg_amount
  FROM tx WHERE d = DATE '2024-01-15' GROUP BY bank_entity"""


@query("a4_daily_summary", sql("tx", SUMMARY))
def a4(spark, sf):
    return A.daily_summary(fx.tx(spark, sf), fx.TODAY)


BRANCH_TABLE = """SELECT b.*, CAST(NULL AS DOUBLE) AS avg_wait_time_minutes, u.utilization_rate
  FROM branch b JOIN util u USING (bank_entity, metric_date, branch_id)"""
ROLLED = f"""SELECT bank_entity, branch_id, channel_type, sum(total_transactions)::BIGINT AS total_transactions,
  sum(CAST(total_amount AS DECIMAL(38,9)))::DOUBLE AS total_amount,
  sum(CAST(utilization_rate AS DECIMAL(18,9)))::DOUBLE / count(*) AS avg_utilization, CAST(NULL AS DOUBLE) AS avg_wait_time
  FROM ({BRANCH_TABLE}) WHERE metric_date >= TIMESTAMP '2024-01-24' GROUP BY ALL"""


@query("a5_branch_rollup", sql("branch util", ROLLED))
def a5(spark, sf):
    return A.branch_rollup(A.branch_volume(fx.tx(spark, sf)), fx.AS_OF, 7)


@query("a6_row_counts", sql("tx", """
    SELECT 'loaded' AS stage, count(*) AS n FROM tx WHERE transaction_timestamp >= TIMESTAMP '2024-01-17'
    UNION ALL SELECT 'labelled', count(is_fraud) FROM tx WHERE transaction_timestamp >= TIMESTAMP '2024-01-17'"""))
def a6(spark, sf):
    tx = files.lookback(fx.tx(spark, sf), fx.AS_OF, fx.LOOKBACK_DAYS)
    return tx.agg(F.count(F.lit(1)).alias("loaded"), F.count("is_fraud").alias("labelled")).unpivot(
        [], ["loaded", "labelled"], "stage", "n")


@query("a7_kpi_windows", sql("kpis", "SELECT * FROM kpis"))
def a7(spark, sf):
    return A.kpi_rows(A.kpi_counts(fx.tx(spark, sf)))


@query("a8_consolidated_report", sql("tx kinds", """
    SELECT sha256('DAILY|' || bank_entity || '|' || d) AS report_id, 'DAILY' AS report_type, bank_entity, CAST(d AS TIMESTAMP) AS report_date,
      count(*) AS total_transactions, sum(cents)::DOUBLE AS total_amount, count(*) FILTER (status = 'BLOCKED') AS fraud_blocked_count,
      coalesce(sum(cents) FILTER (status = 'BLOCKED'), 0)::DOUBLE AS fraud_blocked_amount,
      sum(event_id % 500)::DOUBLE / count(*) AS avg_processing_time_ms,
      (SELECT '{' || string_agg('"' || transaction_type || '":' || n, ',' ORDER BY transaction_type) || '}' FROM kinds k
        WHERE k.bank_entity = tx.bank_entity AND k.d = tx.d) AS details
    FROM tx GROUP BY bank_entity, d"""))
def a8(spark, sf):
    return A.consolidated_report(fx.tx(spark, sf))


@query("a9_average_score", sql("tx", """
    SELECT bank_entity, sum(CAST(fraud_score AS DECIMAL(18,6)))::DOUBLE / count(*) AS avg_fraud_score FROM tx GROUP BY 1"""))
def a9(spark, sf):
    return A.average_score(fx.tx(spark, sf))


@query("a10_blocked_by_hour", sql("tx", """
    SELECT date_trunc('hour', transaction_timestamp) AS hour_start, count(*) FILTER (status = 'BLOCKED') AS blocked,
      coalesce(sum(cents) FILTER (status = 'BLOCKED'), 0)::DOUBLE AS blocked_amount FROM tx GROUP BY 1"""))
def a10(spark, sf):
    return A.blocked_by_hour(fx.tx(spark, sf))


@query("a11_branch_heat_map", sql("tx", """
    SELECT branch_id, count(*) FILTER (channel = 'APP') AS "APP", count(*) FILTER (channel = 'ATM') AS "ATM", count(*) FILTER (channel = 'BRANCH') AS "BRANCH",
      count(*) FILTER (channel = 'CORRESPONDENT') AS "CORRESPONDENT" FROM tx WHERE branch_id IS NOT NULL GROUP BY 1"""))
def a11(spark, sf):
    return A.branch_heat_map(fx.tx(spark, sf))


@query("a12_branch_utilization", sql("util", """
    SELECT u.*, CASE WHEN utilization_rate >= hi THEN 'CONGESTED' WHEN utilization_rate <= lo THEN 'UNDERUSED' ELSE 'NORMAL' END AS load_class
    FROM util u JOIN (SELECT bank_entity, metric_date, quantile_cont(utilization_rate, 0.1) AS lo, quantile_cont(utilization_rate, 0.9) AS hi
      FROM util GROUP BY ALL) q USING (bank_entity, metric_date)"""))
def a12(spark, sf):
    return A.branch_utilization(A.branch_metrics(fx.tx(spark, sf)))


@query("a13_regulator_totals", sql("tx", """
    SELECT CASE WHEN grouping(bank_entity) = 1 THEN 'ALL' ELSE bank_entity END AS bank_entity, grouping(bank_entity) AS is_network,
      count(*) AS total_transactions, sum(cents)::DOUBLE AS total_amount, count(*) FILTER (status = 'BLOCKED') AS blocked_count
    FROM tx GROUP BY ROLLUP (bank_entity)"""))
def a13(spark, sf):
    return A.regulator_totals(fx.tx(spark, sf))


@query("a14_channel_type_cube", sql("tx", """
    SELECT channel, transaction_type, grouping(channel) * 2 + grouping(transaction_type) AS level, count(*) AS total_transactions,
      sum(cents)::DOUBLE AS total_amount FROM tx GROUP BY CUBE (channel, transaction_type)"""))
def a14(spark, sf):
    return A.channel_type_cube(fx.tx(spark, sf))


@query("a15_reconcile_closes", sql("tx", """
    SELECT bank_entity, d AS close_date, count(*) + CASE WHEN day(d) % 7 = 0 THEN 1 ELSE 0 END AS declared_count,
      sum(cents)::DOUBLE AS declared_amount, count(*) AS computed_count, sum(cents)::DOUBLE AS computed_amount,
      CASE WHEN day(d) % 7 = 0 THEN 1 ELSE 0 END AS count_diff, 0.0::DOUBLE AS amount_diff, day(d) % 7 <> 0 AS matches
    FROM tx GROUP BY bank_entity, d"""))
def a15(spark, sf):
    root = new_folder(spark, "closes")
    K.land_daily_close(fx.daily_closes(spark, sf), root)
    return A.reconcile(files.read_daily_close(spark, root), fx.tx(spark, sf))


@query("a16_approx_customers")
def a16(spark, sf):
    return A.movement_trends(fx.tx(spark, sf), approx_customers=True)


# Joins.

@query("j1_enrich", sql("tx prof", """
    SELECT segment, country_code, count(*) AS n, sum(cents)::DOUBLE AS total_amount, count(DISTINCT t.customer_id) AS customers
    FROM tx t LEFT JOIN prof p ON t.customer_id = p.customer_id GROUP BY ALL"""))
def j1(spark, sf):
    joined = J.enrich(fx.tx(spark, sf), fx.profiles(spark, sf))
    return joined.groupBy("segment", "country_code").agg(
        F.count(F.lit(1)).alias("n"), total("amount").alias("total_amount"), F.count_distinct("customer_id").alias("customers"))


@query("j1_enrich_rows", sql("tx prof", """
    SELECT transaction_id, t.customer_id, bank_entity, amount, status, name, segment, balance, country_code
    FROM tx t LEFT JOIN prof p ON t.customer_id = p.customer_id"""))
def j1_rows(spark, sf):
    return J.enrich(fx.tx(spark, sf), fx.profiles(spark, sf)).select(
        "transaction_id", "customer_id", "bank_entity", "amount", "status", "name", "segment", "balance", "country_code")


FORECAST = """
  SELECT b.bank_entity, b.date, round(coalesce(p.i, w.i), 4) AS predicted_inflow, round(coalesce(p.o, w.o), 4) AS predicted_outflow,
    round(coalesce(p.n, w.n), 4) AS net_liquidity,
    round(coalesce(p.n, w.n) - 1.96 * coalesce(p.s, w.s, 0), 4) AS confidence_interval_lower,
    round(coalesce(p.n, w.n) + 1.96 * coalesce(p.s, w.s, 0), 4) AS confidence_interval_upper, 'seasonal-1' AS model_version,
    CAST(b.date AS VARCHAR) IN ('2024-01-01', '2024-01-08') AS is_holiday, b.is_payday
  FROM (SELECT bank_entity, CAST(dd AS DATE) AS date, day(dd) IN (1, 15, 30) AS is_payday, dayofweek(dd) + 1 AS day_of_week
        FROM (SELECT DISTINCT bank_entity FROM liq), (SELECT unnest(generate_series({lo}, {hi}, INTERVAL 1 DAY)) AS dd)) b
  LEFT JOIN (SELECT bank_entity, day_of_week, is_payday, sum(CAST(total_inflow AS DECIMAL(38,9)))::DOUBLE / count(*) AS i,
      sum(CAST(total_outflow AS DECIMAL(38,9)))::DOUBLE / count(*) AS o, sum(CAST(net_liquidity AS DECIMAL(38,9)))::DOUBLE / count(*) AS n,
      stddev_samp(net_liquidity) AS s FROM liq WHERE date <= {asof} GROUP BY ALL) p
    ON b.bank_entity = p.bank_entity AND b.day_of_week = p.day_of_week AND b.is_payday = p.is_payday
  LEFT JOIN (SELECT bank_entity, day_of_week, sum(CAST(total_inflow AS DECIMAL(38,9)))::DOUBLE / count(*) AS i,
      sum(CAST(total_outflow AS DECIMAL(38,9)))::DOUBLE / count(*) AS o, sum(CAST(net_liquidity AS DECIMAL(38,9)))::DOUBLE / count(*) AS n,
      stddev_samp(net_liquidity) AS s FROM liq WHERE date <= {asof} GROUP BY ALL) w
    ON b.bank_entity = w.bank_entity AND b.day_of_week = w.day_of_week"""
AHEAD = FORECAST.format(asof="DATE '2024-01-30'", lo="TIMESTAMP '2024-01-31'", hi="TIMESTAMP '2024-02-06'")
LAST_DAY = FORECAST.format(asof="DATE '2024-01-29'", lo="TIMESTAMP '2024-01-30'", hi="TIMESTAMP '2024-02-05'")


@query("m9_liquidity_forecast", sql("liq", f"SELECT sha256(bank_entity || '|' || date || '|seasonal-1') AS forecast_id, * FROM ({AHEAD})"))
def m9(spark, sf):
    return P.seasonal_forecast(A.daily_liquidity(fx.tx(spark, sf)), "2024-01-30", 7, fx.HOLIDAYS)


@query("j2_forecast_vs_realised", sql("liq", f"""
    SELECT coalesce(f.bank_entity, r.bank_entity) AS bank_entity, coalesce(f.date, r.date) AS date, predicted_inflow, predicted_outflow,
      total_inflow, total_outflow, round(predicted_inflow - total_inflow, 4) AS inflow_error,
      round(predicted_outflow - total_outflow, 4) AS outflow_error
    FROM ({LAST_DAY}) f FULL JOIN (SELECT * FROM liq WHERE date = DATE '2024-01-30') r ON f.bank_entity = r.bank_entity AND f.date = r.date"""))
def j2(spark, sf):
    daily = A.daily_liquidity(fx.tx(spark, sf))
    forecast = P.seasonal_forecast(daily, "2024-01-29", 7, fx.HOLIDAYS).select("bank_entity", "date", "predicted_inflow", "predicted_outflow")
    realised = daily.filter(F.col("date") == "2024-01-30").select("bank_entity", "date", "total_inflow", "total_outflow")
    return J.forecast_vs_realised(forecast, realised).withColumn("inflow_error", F.round("inflow_error", 4)).withColumn(
        "outflow_error", F.round("outflow_error", 4))


@query("j3_cross_bank_fraud", sql("act", """
    SELECT a.customer_id, a.bank_entity AS flagged_bank, any_value(a.n) AS transactions_here, any_value(a.blocked) AS blocked_here,
      string_agg(b.bank_entity, ',' ORDER BY b.bank_entity) AS blocked_at, sum(b.blocked)::BIGINT AS blocked_elsewhere,
      min(b.first_blocked_ts) AS first_blocked_ts
    FROM act a JOIN act b ON a.customer_id = b.customer_id AND a.bank_entity <> b.bank_entity AND b.blocked > 0
    GROUP BY a.customer_id, a.bank_entity"""))
def j3(spark, sf):
    return J.cross_bank_fraud(fx.tx(spark, sf))


@query("j4_after_suspicion", sql("tx", """
    SELECT transaction_id, customer_id, bank_entity, status, transaction_timestamp FROM tx t WHERE EXISTS (
      SELECT 1 FROM tx s WHERE s.customer_id = t.customer_id AND s.status = 'BLOCKED' AND s.transaction_timestamp < t.transaction_timestamp)"""))
def j4(spark, sf):
    return J.after_suspicion(fx.tx(spark, sf)).select("transaction_id", "customer_id", "bank_entity", "status", "transaction_timestamp")


FOLLOW_UPS = """
    SELECT transaction_id, customer_id, bank_entity, status, transaction_timestamp FROM tx t WHERE EXISTS (
      SELECT 1 FROM tx s WHERE s.customer_id = t.customer_id AND s.bank_entity <> t.bank_entity AND s.status = 'BLOCKED'
        AND t.transaction_timestamp BETWEEN s.transaction_timestamp AND s.transaction_timestamp + INTERVAL 1 HOUR)"""


@query("j5_follow_ups", sql("tx", FOLLOW_UPS))
def j5(spark, sf):
    return J.follow_ups(fx.tx(spark, sf)).select("transaction_id", "customer_id", "bank_entity", "status", "transaction_timestamp")


@query("j6_new_rows", sql("tx", "SELECT transaction_id, bank_entity, amount FROM tx WHERE d > DATE '2024-01-20'"))
def j6(spark, sf):
    tx = fx.tx(spark, sf)
    stored = tx.filter(F.col("transaction_timestamp") < "2024-01-21")
    return J.new_rows(tx, stored, ["transaction_id"]).select("transaction_id", "bank_entity", "amount")


@query("j7_calendar", sql("tx cal", """
    SELECT d AS date, is_holiday, is_payday, n, total_amount FROM
      (SELECT d, count(*) AS n, sum(cents)::DOUBLE AS total_amount FROM tx GROUP BY d) LEFT JOIN cal ON d = cal.date"""))
def j7(spark, sf):
    daily = fx.tx(spark, sf).groupBy(F.to_date("transaction_timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), total("amount").alias("total_amount"))
    return J.with_calendar(daily, fx.bank_calendar(spark, sf))


AS_OF_RATE = """SELECT t.transaction_id, t.bank_entity, t.currency, t.amount, f.rate, t.amount * f.rate AS amount_home
  FROM tx t ASOF LEFT JOIN (SELECT base_currency, "timestamp", max(rate) AS rate FROM fx GROUP BY ALL) f
  ON t.currency = f.base_currency AND t.transaction_timestamp >= f."timestamp" """


@query("j8_fx_normalised", sql("tx fx", AS_OF_RATE))
def j8(spark, sf):
    return J.fx_normalise(fx.tx(spark, sf), fx.fx_ticks(spark, sf)).select(
        "transaction_id", "bank_entity", "currency", "amount", "rate", "amount_home")


@query("j8_home_totals", sql("tx fx", f"""
    SELECT bank_entity, currency, count(*) AS n, count(rate) AS priced, sum(CAST(amount_home AS DECIMAL(38,9)))::DOUBLE AS total_home
    FROM ({AS_OF_RATE}) GROUP BY ALL"""))
def j8_totals(spark, sf):
    return J.home_totals(J.fx_normalise(fx.tx(spark, sf), fx.fx_ticks(spark, sf)))


@query("j9_rates_on_day", sql("tx prof rates", """
    SELECT g.country_code, g.date, g.n, g.total_amount, r.rate_type, r.rate_value, r.effective_date FROM
      (SELECT country_code, d AS date, count(*) AS n, sum(cents)::DOUBLE AS total_amount FROM tx t JOIN prof p ON t.customer_id = p.customer_id GROUP BY ALL) g
    ASOF LEFT JOIN rates r ON g.country_code = r.country_code AND g.date >= r.effective_date"""))
def j9(spark, sf):
    daily = J.enrich(fx.tx(spark, sf), fx.profiles(spark, sf)).filter(F.col("country_code").isNotNull()).groupBy(
        "country_code", F.to_date("transaction_timestamp").alias("date")).agg(F.count(F.lit(1)).alias("n"), total("amount").alias("total_amount"))
    return J.rates_on(daily, fx.interest_rates(spark, sf))


@query("j10_p26_status_lookup", sql("tx", """
    SELECT 'T' || o_orderkey AS transaction_id, coalesce(c.status, t.status, 'UNKNOWN') AS status,
      CASE WHEN c.status IS NOT NULL THEN 'cache' WHEN t.status IS NOT NULL THEN 'warehouse' ELSE 'none' END AS found_in
    FROM orders LEFT JOIN tx t ON t.transaction_id = 'T' || o_orderkey
    LEFT JOIN (SELECT * FROM tx WHERE processing_timestamp > TIMESTAMP '2024-01-30 22:00:00' AND processing_timestamp <= TIMESTAMP '2024-01-30 23:00:00') c
      ON c.transaction_id = 'T' || o_orderkey"""))
def j10(spark, sf):
    tx = fx.tx(spark, sf)
    asked = fx.table(spark, sf, "orders").select(F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("transaction_id"))
    return J.status_lookup(asked, J.recent_cache(tx, "2024-01-30 23:00:00"), tx)


@query("j11_outside_catalog", sql("tx_all", """
    SELECT transaction_type, count(*) AS n FROM tx_all WHERE transaction_type NOT IN ('TRANSFER', 'PAYMENT', 'WITHDRAWAL', 'DEPOSIT') GROUP BY 1"""))
def j11(spark, sf):
    catalog = spark.createDataFrame([(t,) for t in ("TRANSFER", "PAYMENT", "WITHDRAWAL", "DEPOSIT")], "transaction_type string")
    return J.outside_catalog(fx.all_tx(spark, sf), catalog, "transaction_type").groupBy("transaction_type").agg(F.count(F.lit(1)).alias("n"))


# Windows.

TREND_ROWS = "(SELECT bank_entity, d AS date, sum(cents)::DOUBLE AS total_amount, count(*) FILTER (status = 'APPROVED')::DOUBLE / count(*) AS approval_rate FROM {t} GROUP BY ALL)"


@query("w1_day_over_day", sql("tx", f"""
    SELECT bank_entity, date, total_amount, lag(total_amount) OVER w AS previous_amount,
      (CAST(total_amount AS DECIMAL(38,9)) - CAST(lag(total_amount) OVER w AS DECIMAL(38,9)))::DOUBLE AS amount_change,
      approval_rate - lag(approval_rate) OVER w AS rate_change
    FROM {TREND_ROWS.format(t="tx")} WINDOW w AS (PARTITION BY bank_entity ORDER BY date)"""))
def w1(spark, sf):
    return W.day_over_day(A.movement_trends(fx.tx(spark, sf))).select(
        "bank_entity", "date", "total_amount", "previous_amount", "amount_change", "rate_change")


@query("w2_month_over_month", sql("li", f"""
    SELECT a.bank_entity, a.date, a.total_amount, b.total_amount AS last_month_amount,
      (CAST(a.total_amount AS DECIMAL(38,9)) - CAST(b.total_amount AS DECIMAL(38,9)))::DOUBLE AS amount_change
    FROM {TREND_ROWS.format(t="li")} a LEFT JOIN {TREND_ROWS.format(t="li")} b
    ON a.bank_entity = b.bank_entity AND b.date = CAST(a.date - INTERVAL 1 MONTH AS DATE) AND day(b.date) = day(a.date)"""))
def w2(spark, sf):
    return W.month_over_month(A.movement_trends(fx.tx_lineitem(spark, sf)).select("bank_entity", "date", "total_amount"))


@query("w3_velocity", sql("tx", """
    SELECT transaction_id, customer_id, transaction_timestamp, count(*) OVER w AS tx_in_window, (sum(cents) OVER w)::DOUBLE AS amount_in_window
    FROM tx WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_timestamp RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)"""))
def w3(spark, sf):
    return W.velocity(fx.tx(spark, sf)).select("transaction_id", "customer_id", "transaction_timestamp", "tx_in_window", "amount_in_window")


LATEST = """SELECT {cols} FROM tx QUALIFY row_number() OVER
  (PARTITION BY bank_entity, customer_id ORDER BY transaction_timestamp DESC, transaction_id DESC) = 1"""


@query("w4_k6_last_transaction", sql("tx", LATEST.format(cols="""bank_entity, customer_id, transaction_id, amount, status, transaction_timestamp,
      'customer:' || bank_entity || ':' || customer_id || ':last_txn' AS cache_key""")))
def w4(spark, sf):
    return J.last_transactions(fx.tx(spark, sf)).select(
        "bank_entity", "customer_id", "transaction_id", "amount", "status", "transaction_timestamp", "cache_key")


@query("w5_top_suspects", sql("tx", """
    SELECT * FROM (SELECT bank_entity, customer_id, blocked, score_sum,
        dense_rank() OVER (PARTITION BY bank_entity ORDER BY blocked DESC, score_sum DESC, customer_id) AS rank FROM
      (SELECT bank_entity, customer_id, count(*) FILTER (status = 'BLOCKED') AS blocked,
        sum(CAST(fraud_score AS DECIMAL(18,6)))::DOUBLE AS score_sum FROM tx GROUP BY ALL)) WHERE rank <= 3"""))
def w5(spark, sf):
    return W.top_suspects(fx.tx(spark, sf), 3)


@query("w6_latest_rates", sql("fx", """
    SELECT * FROM fx QUALIFY row_number() OVER (PARTITION BY base_currency, quote_currency ORDER BY "timestamp" DESC, pair_id DESC) = 1"""))
def w6(spark, sf):
    return W.latest_rates(fx.fx_ticks(spark, sf))


@query("w7_trailing_liquidity", sql("liq", """
    SELECT bank_entity, date, net_liquidity, count(*) OVER w AS days_used,
      round((sum(CAST(net_liquidity AS DECIMAL(38,9))) OVER w)::DOUBLE / count(*) OVER w, 4) AS trailing_mean,
      round(stddev_samp(net_liquidity) OVER w, 4) AS trailing_sd
    FROM liq WINDOW w AS (PARTITION BY bank_entity ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""))
def w7(spark, sf):
    return W.trailing_liquidity(A.daily_liquidity(fx.tx(spark, sf)))


USE = """SELECT bank_entity, customer_id, count(*) AS transactions, sum(cents)::DOUBLE AS total_amount,
    count(*) FILTER (transaction_type = 'DEPOSIT') AS deposits, count(*) FILTER (transaction_type = 'WITHDRAWAL') AS withdrawals,
    count(*) FILTER (transaction_type = 'PAYMENT') AS payments, count(*) FILTER (transaction_type = 'TRANSFER') AS transfers,
    count(*) FILTER (status = 'BLOCKED') AS blocked FROM tx GROUP BY ALL"""
RANKED = f"SELECT *, percent_rank() OVER (PARTITION BY bank_entity ORDER BY total_amount) AS rank_score FROM ({USE})"


@query("w8_customer_rank", sql("tx", f"SELECT bank_entity, customer_id, transactions, total_amount, rank_score FROM ({RANKED})"))
def w8(spark, sf):
    return P.customer_rank(P.customer_features(fx.tx(spark, sf))).select(
        "bank_entity", "customer_id", "transactions", "total_amount", "rank_score")


@query("m10_recommendations", sql("tx", f"""
    SELECT sha256(bank_entity || '|' || customer_id || '|' || product_type) AS product_id, customer_id, bank_entity, product_type, CASE product_type WHEN 'MICRO_CREDIT' THEN 'Micro Credit offer' WHEN 'SAVINGS' THEN 'Savings offer'
        WHEN 'INSURANCE' THEN 'Insurance offer' ELSE 'Investment offer' END AS product_name,
      round(rank_score * (used::DOUBLE / transactions) * CASE WHEN blocked > 0 THEN 0.5 ELSE 1.0 END::DOUBLE, 6) AS recommendation_score,
      TIMESTAMP '2024-01-31' AS generated_at,
      '{{"transactions":' || transactions || ',"deposits":' || deposits || ',"withdrawals":' || withdrawals || ',"payments":' || payments
        || ',"transfers":' || transfers || ',"blocked":' || blocked || '}}' AS features
    FROM (SELECT *, unnest(['MICRO_CREDIT', 'SAVINGS', 'INSURANCE', 'INVESTMENT']) AS product_type,
      unnest([withdrawals, deposits, payments, transfers]) AS used FROM ({RANKED}))"""))
def m10(spark, sf):
    return P.recommendations(fx.tx(spark, sf), fx.AS_OF)


# Ordered pages.

@query("t1_forecast_page", sql("liq", """
    SELECT sha256(bank_entity || '|' || date) AS forecast_id, bank_entity, CAST(date AS TIMESTAMP) AS forecast_date,
      total_inflow AS predicted_inflow, total_outflow AS predicted_outflow, net_liquidity, is_payday FROM liq WHERE date >= TIMESTAMP '2024-01-01' ORDER BY bank_entity, date DESC LIMIT 1000"""))
def t1(spark, sf):
    rows = K.liquidity_rows(A.daily_liquidity(fx.tx(spark, sf)), fx.AS_OF)
    return jobs.liquidity_report(rows, fx.AS_OF)


@query("t2_kpi_page", sql("kpis", """
    SELECT bank_entity, kpi_name, kpi_value, window_start, window_end FROM kpis WHERE window_start >= TIMESTAMP '2024-01-30 00:00:00'
    ORDER BY window_start DESC, bank_entity, kpi_name LIMIT 500"""))
def t2(spark, sf):
    return jobs.kpi_report(A.kpi_rows(A.kpi_counts(fx.tx(spark, sf))), fx.AS_OF, hours=24)


@query("t3_summary_page", sql("tx", SUMMARY + " ORDER BY total_transactions DESC"))
def t3(spark, sf):
    return jobs.summary_report(fx.tx(spark, sf), fx.TODAY)


@query("t4_branch_page", sql("branch util", f"SELECT * FROM ({ROLLED}) ORDER BY total_transactions DESC, bank_entity, branch_id, channel_type LIMIT 500"))
def t4(spark, sf):
    return jobs.branch_report(A.branch_volume(fx.tx(spark, sf)), fx.AS_OF, days=7)


@query("t5_p27_fx_page", sql("fx", 'SELECT * FROM fx ORDER BY "timestamp" DESC, pair_id LIMIT 100'))
def t5(spark, sf):
    return jobs.fx_report(fx.fx_ticks(spark, sf))


@query("t6_top_customers", sql("tx", """
    SELECT customer_id, sum(CAST(fraud_score AS DECIMAL(18,6)))::DOUBLE AS score_sum, count(*) AS n FROM tx
    WHERE transaction_timestamp >= TIMESTAMP '2024-01-24' GROUP BY 1 ORDER BY score_sum DESC, customer_id LIMIT 20"""))
def t6(spark, sf):
    return W.top_customers(fx.tx(spark, sf), fx.AS_OF, 7, 20)


# Set operations.

@query("u1_merged_feeds", sql("tx", """
    SELECT bank_entity, count(*) AS n, sum(cents)::DOUBLE AS total_amount, count(branch_id) AS with_branch FROM tx GROUP BY 1"""))
def u1(spark, sf):
    root = new_folder(spark, "feeds")
    K.fan_out(fx.tx(spark, sf), root)
    feeds = [K.subscription(spark, root, bank) for bank in fx.BANKS]
    feeds[0] = feeds[0].drop("device_id")  # a bank may not send every column
    return J.merge_feeds(feeds).groupBy("bank_entity").agg(
        F.count(F.lit(1)).alias("n"), total("amount").alias("total_amount"), F.count("branch_id").alias("with_branch"))


@query("u2_unified_view", sql("tx", """
    SELECT transaction_id, amount, CASE WHEN d >= DATE '2024-01-29' THEN 'hot' ELSE 'cold' END AS origin FROM tx"""))
def u2(spark, sf):
    tx = fx.tx(spark, sf)
    hot = tx.filter(F.col("transaction_timestamp") >= "2024-01-29").withColumn("origin", F.lit("hot"))
    cold = tx.filter(F.col("transaction_timestamp") < "2024-01-30").withColumn("origin", F.lit("cold"))
    return J.unified_view(hot, cold).select("transaction_id", "amount", "origin")


@query("m11_cross_bank_detection", sql("act", """
    SELECT count(*) AS multi_bank_suspects, count(*) FILTER (hit) AS flagged_elsewhere, count(*) FILTER (hit)::DOUBLE / count(*) AS detection_rate,
      count(*) FILTER (hit)::DOUBLE / count(*) >= 0.9 AS meets_target
    FROM (SELECT *, EXISTS (SELECT 1 FROM tx t WHERE t.customer_id = s.customer_id AND t.bank_entity <> s.bank_entity
          AND t.status IN ('BLOCKED', 'PENDING') AND t.transaction_timestamp > s.first_blocked_ts) AS hit
      FROM (SELECT customer_id, bank_entity, first_blocked_ts FROM act WHERE blocked > 0
          AND customer_id IN (SELECT customer_id FROM act GROUP BY 1 HAVING count(*) > 1)
          QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY first_blocked_ts, bank_entity) = 1) s)"""))
def m11(spark, sf):
    return J.cross_bank_detection(fx.tx(spark, sf))


@query("m12_confusion", sql("tx", """
    SELECT count(*) FILTER (is_fraud = 1 AND status = 'BLOCKED') AS true_positive, count(*) FILTER (is_fraud = 0 AND status = 'BLOCKED') AS false_positive,
      count(*) FILTER (is_fraud = 1 AND status <> 'BLOCKED') AS false_negative, count(*) FILTER (is_fraud = 0 AND status <> 'BLOCKED') AS true_negative,
      count(*) FILTER (is_fraud = 1 AND status = 'BLOCKED')::DOUBLE / count(*) FILTER (status = 'BLOCKED') AS precision,
      count(*) FILTER (is_fraud = 1 AND status = 'BLOCKED')::DOUBLE / count(*) FILTER (is_fraud = 1) AS recall FROM tx"""))
def m12(spark, sf):
    return P.confusion(fx.tx(spark, sf))


@query("m12_label_by_status", sql("tx", "SELECT is_fraud, status, count(*) AS n FROM tx GROUP BY ALL"))
def m12_counts(spark, sf):
    return P.label_by_status(fx.tx(spark, sf))


SESSIONS = """
    SELECT customer_id, session_no::BIGINT AS session_no, min(transaction_timestamp) AS session_start, count(*) AS transactions,
      sum(cents)::DOUBLE AS amount, max(transaction_timestamp) + INTERVAL 30 MINUTE AS session_end
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id ROWS UNBOUNDED PRECEDING) AS session_no
      FROM (SELECT *, CASE WHEN transaction_timestamp - lag(transaction_timestamp) OVER (PARTITION BY customer_id
          ORDER BY transaction_timestamp, transaction_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM tx))
    GROUP BY customer_id, session_no"""


@query("r7_sessions", sql("tx", SESSIONS))
def r7(spark, sf):
    return W.sessions(fx.tx(spark, sf))


SLIDING = """
    SELECT customer_id, ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, count(*) AS transactions, sum(cents)::DOUBLE AS amount
    FROM (SELECT customer_id, cents, unnest([b, b - INTERVAL 15 MINUTE, b - INTERVAL 30 MINUTE, b - INTERVAL 45 MINUTE]) AS ws
      FROM (SELECT customer_id, cents, time_bucket(INTERVAL 15 MINUTE, transaction_timestamp) AS b FROM tx)) GROUP BY ALL"""


@query("r6_sliding_velocity", sql("tx", SLIDING))
def r6(spark, sf):
    return W.sliding_counts(fx.tx(spark, sf))


@query("s13_calendar", sql("cal", "SELECT * FROM cal"))
def s13(spark, sf):
    return fx.bank_calendar(spark, sf)


@query("p20_p22_flags", sql("tx", """
    SELECT transaction_id, dayofweek(d) IN (0, 6) AS is_weekend, day(d) IN (1, 15, 30) AS is_payday,
      day(d) IN (1, 15, 30) OR last_day(d) = d AS is_payday_month_end, transaction_type IN ('DEPOSIT', 'TRANSFER_IN') AS is_inflow,
      cents::DOUBLE AS amount FROM tx"""))
def p20(spark, sf):
    from bankweave.functions import is_inflow, is_payday

    ts = "transaction_timestamp"
    return fx.tx(spark, sf).select(
        "transaction_id", is_weekend(ts).alias("is_weekend"), is_payday(ts).alias("is_payday"),
        is_payday(ts, include_last_day=True).alias("is_payday_month_end"), is_inflow().alias("is_inflow"),
        money("amount").cast("double").alias("amount"))
