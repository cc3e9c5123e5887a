"""Registered queries: sinks, retention, erasure, quarantine and retry."""

from __future__ import annotations

from pyspark.sql import functions as F

from bankweave import schemas as S
from bankweave.functions import money, ts_lit
from bankweave.operators import aggregates as A
from bankweave.operators import joins as J
from bankweave.operators import tables as K
from bankweave.operators import validate as V
from bankweave.plans.registry import query, sql
from bankweave.plans.reports import BRANCH_TABLE, LATEST
from bankweave.session import new_folder
from bankweave.sources import files
from bankweave.sources import fixtures as fx


@query("k1_append_liquidity", sql("liq", """
    SELECT sha256(bank_entity || '|' || date) AS forecast_id, bank_entity, CAST(date AS TIMESTAMP) AS forecast_date, date AS forecast_day, total_inflow AS predicted_inflow,
      total_outflow AS predicted_outflow, net_liquidity, is_payday, CASE WHEN date < DATE '2024-01-10' THEN '20240131_000000' ELSE '20240201_000000' END AS run_id
    FROM liq"""))
def k1(spark, sf):
    """Two overlapping runs leave one row for each bank and day, the later run's where both have one."""
    path, daily = new_folder(spark, "liquidity"), A.daily_liquidity(fx.tx(spark, sf))
    K.append_liquidity(daily, path, "2024-01-31 00:00:00")
    K.append_liquidity(daily.filter(F.col("date") >= "2024-01-10"), path, "2024-02-01 00:00:00")
    return spark.read.parquet(path)


@query("k2_append_branches", sql("branch util", f"""
    SELECT sha256(bank_entity || '|' || branch_id || '|' || channel_type || '|' || metric_date) AS metric_id, bank_entity, branch_id, channel_type,
      CAST(metric_date AS TIMESTAMP) AS metric_date, total_transactions, total_amount, avg_wait_time_minutes, utilization_rate, peak_hour FROM ({BRANCH_TABLE})"""))
def k2(spark, sf):
    """Two overlapping runs equal one."""
    path, rows = new_folder(spark, "branches"), A.branch_volume(fx.tx(spark, sf))
    K.append_branches(rows.filter(F.col("metric_date") < "2024-01-20"), path)
    K.append_branches(rows.filter(F.col("metric_date") >= "2024-01-10"), path)
    return spark.read.parquet(path).drop("metric_day")


@query("k4_profile_snapshot", sql("tx", LATEST.format(cols="""bank_entity || '#' || customer_id AS row_key, bank_entity, customer_id, amount AS last_amount,
      transaction_type AS last_transaction_type, channel AS last_channel, fraud_score, status AS last_status,
      transaction_timestamp AS updated_at, transaction_id AS updated_by""")))
def k4(spark, sf):
    p = J.profile_snapshot(fx.tx(spark, sf))
    fin, risk = "financial_data", "risk_score"
    return p.select(
        "row_key", "bank_entity", "customer_id", F.col(f"{fin}.last_transaction_amount").cast("double").alias("last_amount"),
        f"{fin}.last_transaction_type", f"{fin}.last_channel", F.col(f"{risk}.fraud_score").cast("double").alias("fraud_score"),
        f"{risk}.last_status", "updated_at", "updated_by")


@query("k5_recent_cache", sql("tx", """
    SELECT 'txn:' || transaction_id AS cache_key, transaction_id, status, amount AS v_amount, bank_entity AS v_bank FROM tx
    WHERE processing_timestamp > TIMESTAMP '2024-01-30 22:00:00' AND processing_timestamp <= TIMESTAMP '2024-01-30 23:00:00'"""))
def k5(spark, sf):
    c = J.recent_cache(fx.tx(spark, sf), "2024-01-30 23:00:00")
    return c.select("cache_key", "transaction_id", "status", F.get_json_object("value", "$.amount").cast("double").alias("v_amount"),
                    F.get_json_object("value", "$.bank_entity").alias("v_bank"))


@query("k7_fan_out", sql("tx", "SELECT bank_entity, status, count(*) AS n FROM tx GROUP BY ALL"))
def k7(spark, sf):
    path = new_folder(spark, "fanout")
    K.fan_out(fx.tx(spark, sf), path)
    return J.merge_feeds([K.subscription(spark, path, b).groupBy("bank_entity", "status").agg(F.count(F.lit(1)).alias("n")) for b in fx.BANKS])


@query("k8_append_new", sql("tx", "SELECT transaction_id, bank_entity, amount, status, d AS tx_date FROM tx"))
def k8(spark, sf):
    """The table is loaded in overlapping parts that also repeat rows, and ends with each id once."""
    path, tx = new_folder(spark, "dedup"), fx.tx(spark, sf)
    early, late = tx.filter(F.col("transaction_timestamp") < "2024-01-20"), tx.filter(F.col("transaction_timestamp") >= "2024-01-10")
    K.append_new(early.unionByName(early), path)
    K.append_new(late, path)
    K.append_new(late, path)
    return spark.read.parquet(path).select("transaction_id", "bank_entity", "amount", "status", "tx_date")


@query("k9_r11_quarantine", sql("msg", """
    SELECT array_to_string(errors, '; ') AS errors, 1 AS attempt, TIMESTAMP '2024-01-31' AS failed_at, count(*) AS n
    FROM msg WHERE len(errors) > 0 GROUP BY ALL"""))
def k9(spark, sf):
    path = new_folder(spark, "quarantine")
    K.append_quarantine(V.quarantine(V.validate(fx.messages(spark, sf), fx.BANKS), ts_lit(fx.AS_OF)), path)
    return spark.read.parquet(path).groupBy(F.array_join("errors", "; ").alias("errors"), "attempt", "failed_at").agg(F.count(F.lit(1)).alias("n"))


@query("k9_readmission", sql("msg", """
    SELECT 'readmitted' AS outcome, bank_entity, 0 AS attempt, count(*) AS n FROM msg
    WHERE len(errors) = 0 AND bank_entity >= 'bank-06' GROUP BY ALL
    UNION ALL SELECT 'failed', 'any', 2, count(*) FROM msg WHERE len(errors) > 0"""))
def k9_again(spark, sf):
    """Half of the banks were not registered at first: their messages pass now, the others fail again and carry one more attempt."""
    dead = V.quarantine(V.validate(fx.messages(spark, sf), fx.BANKS[:6]), ts_lit("2024-01-30 23:00:00"))
    good, bad = V.readmit(dead, fx.AS_OF, fx.BANKS)
    good = good.groupBy(F.col("doc")["bank_entity"].alias("bank_entity")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("readmitted").alias("outcome"), "bank_entity", F.lit(0).alias("attempt"), "n")
    bad = bad.groupBy("attempt").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("failed").alias("outcome"), F.lit("any").alias("bank_entity"), "attempt", "n")
    return good.unionByName(bad)


@query("k10_enqueue", sql("msg", """
    SELECT bank_entity, transaction_type, channel, 'PENDING' AS status, DATE '2024-01-31' AS arrival_date, count(*) AS n
    FROM msg WHERE len(errors) = 0 GROUP BY ALL"""))
def k10(spark, sf):
    path = new_folder(spark, "queue")
    rows = V.admit(V.accepted(V.validate(fx.messages(spark, sf), fx.BANKS)), ts_lit(fx.AS_OF))
    K.enqueue(rows.drop("arrival_date"), path, fx.AS_OF)
    return spark.read.parquet(path).groupBy("bank_entity", "transaction_type", "channel", "status", "arrival_date").agg(F.count(F.lit(1)).alias("n"))


@query("k14_clustered_layout", sql("tx", "SELECT d AS tx_date, bank_entity, transaction_type, status, count(*) AS n FROM tx WHERE d BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY ALL"))
def k14(spark, sf):
    path = new_folder(spark, "layout")
    K.write_transactions(fx.tx(spark, sf), path)
    days = spark.read.parquet(path).filter(F.col("tx_date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date")))
    return days.groupBy("tx_date", "bank_entity", "transaction_type", "status").agg(F.count(F.lit(1)).alias("n"))


@query("k14_kpi_layout", sql("kpis", "SELECT strftime(window_start, '%Y-%m-%d-%H') AS window_hour, kpi_name, count(*) AS n FROM kpis GROUP BY ALL"))
def k14_kpis(spark, sf):
    path = new_folder(spark, "kpis")
    K.write_kpis(A.kpi_rows(A.kpi_counts(fx.tx(spark, sf))), path)
    hours = spark.read.parquet(path)
    return hours.groupBy(F.col("window_hour").cast("string").alias("window_hour"), "kpi_name").agg(F.count(F.lit(1)).alias("n"))


@query("k15_expire", sql("tx", """
    SELECT d AS tx_date, CASE WHEN d < DATE '2024-01-24' THEN 'COLD' ELSE 'STANDARD' END AS tier, count(*) AS n FROM tx
    WHERE d >= DATE '2024-01-17' GROUP BY ALL"""))
def k15(spark, sf):
    path = new_folder(spark, "retention")
    K.write_transactions(fx.tx(spark, sf), path)
    K.expire(spark, path, fx.AS_OF, days=14)
    return K.tier(spark.read.parquet(path), fx.AS_OF, cold_days=7).groupBy("tx_date", "tier").agg(F.count(F.lit(1)).alias("n"))


@query("k16_erase_customers", sql("tx prof", """
    SELECT d AS tx_date, count(*) AS n, count(DISTINCT t.customer_id) AS customers, sum(cents)::DOUBLE AS amount FROM tx t
    WHERE t.customer_id NOT IN (SELECT customer_id FROM prof WHERE country_code = 'NATION_3') GROUP BY ALL"""))
def k16(spark, sf):
    path = new_folder(spark, "erasure")
    K.write_transactions(fx.tx(spark, sf), path)
    K.erase_customers(spark, path, fx.profiles(spark, sf).filter(F.col("country_code") == "NATION_3").select("customer_id"))
    return spark.read.parquet(path).groupBy("tx_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("customer_id").alias("customers"),
        F.sum(money("amount")).cast("double").alias("amount"))


@query("r12_backoff", sql("", """
    SELECT event_id, 1 + event_id % 6 AS attempt, ts AS failed_at,
      ts + to_seconds(CAST(least(10 * pow(2, event_id % 6), 600) AS BIGINT)) AS next_attempt_at, 1 + event_id % 6 >= 5 AS parked,
      1 + event_id % 6 < 5 AND ts + to_seconds(CAST(least(10 * pow(2, event_id % 6), 600) AS BIGINT)) <= TIMESTAMP '2024-01-30 12:00:00' AS is_due
    FROM events"""))
def r12(spark, sf):
    dead = fx.table(spark, sf, "events").select(
        "event_id", (F.col("event_id") % 6 + 1).cast("int").alias("attempt"), F.col("ts").cast("timestamp").alias("failed_at"))
    due = V.due(dead, "2024-01-30 12:00:00").select("event_id", F.lit(True).alias("_due"))
    return V.with_backoff(dead).join(due, "event_id", "left").withColumn("is_due", F.coalesce("_due", F.lit(False))).drop("_due")


@query("warehouse_rows", sql("tx", """
    SELECT transaction_id, bank_entity, customer_id, transaction_type, amount, currency, source_account, destination_account, destination_bank, channel,
      status, fraud_score, latitude, longitude, device_id, transaction_timestamp, processing_timestamp, CAST(NULL AS VARCHAR) AS metadata FROM tx"""))
def warehouse_rows(spark, sf):
    """Transactions in the declared warehouse types."""
    rows = fx.tx(spark, sf).withColumn("metadata", F.lit(None).cast("string"))
    return files.as_market(rows.filter(F.size(V.warehouse_gaps()) == 0), "transactions").withColumn("amount", F.col("amount").cast("double")).select(
        *S.TRANSACTIONS.fieldNames())
