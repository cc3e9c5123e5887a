"""Analytic windows and top-k.

Plain windows are used only over rows already merged to one per bank and day; windows over
raw rows go through slots, so that no task receives a whole customer or bank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankweave.functions import days_before, epoch_slot, hours_before, money, ratio, ts_lit
from bankweave.operators.scale import latest_by
from bankweave.sources.files import by_bank, since_days


def day_over_day(trends: DataFrame) -> DataFrame:
    """Change of amount and approval rate against the bank's previous active day."""
    w = Window.partitionBy("bank_entity").orderBy("date")
    return trends.withColumn("previous_amount", F.lag("total_amount").over(w)).withColumn(
        "amount_change", (money("total_amount") - money("previous_amount")).cast("double")
    ).withColumn("rate_change", F.col("approval_rate") - F.lag("approval_rate").over(w))


def month_over_month(trends: DataFrame) -> DataFrame:
    """Against the same date of the month before; a date with no such day compares to nothing."""
    before = trends.select("bank_entity", F.col("date").alias("_d"), F.col("total_amount").alias("last_month_amount"))
    same_day = F.dayofmonth(F.add_months("date", -1)) == F.dayofmonth("date")
    return trends.withColumn("_d", F.when(same_day, F.add_months("date", -1))).join(
        before, ["bank_entity", "_d"], "left"
    ).withColumn("amount_change", (money("total_amount") - money("last_month_amount")).cast("double")).drop("_d")


def velocity_instants(tx: DataFrame, window_seconds: int = 3600, slot_seconds: int = 300) -> DataFrame:
    """Transactions and amount of the trailing window, per customer and instant.

    Rows of one instant share one answer, so they are merged first.  Then every instant enters
    at its own time and leaves just after the window has passed: the answer is a running sum
    over entries and exits.  That sum is cut into short slots; a slot opens with the total of
    the slots still inside the window, so a busy customer is spread over many tasks and the
    work stays linear, which a sliding range frame is not.
    """
    if window_seconds % slot_seconds:
        raise ValueError("slot_seconds must divide window_seconds")
    reach = window_seconds // slot_seconds
    slot = epoch_slot("transaction_timestamp", slot_seconds)
    at = tx.groupBy("customer_id", F.unix_micros("transaction_timestamp").alias("_at"), slot.alias("_slot")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(money("amount")).alias("_amt"))

    def step(kind: int, when, where, sign: int):
        return F.struct(F.lit(kind).alias("_kind"), when.alias("_at"), where.alias("_slot"),
                        (F.col("_n") * sign).alias("_n"), money(F.col("_amt") if sign > 0 else -F.col("_amt")).alias("_amt"))  # a product would lose decimals

    moves = at.select("customer_id", F.inline(F.array(
        step(1, F.col("_at"), F.col("_slot"), 1),
        step(2, F.col("_at") + window_seconds * 1_000_000, F.col("_slot") + reach, -1))))
    inside = Window.partitionBy("customer_id").orderBy("_slot").rangeBetween(-reach, -1)
    opening = (
        at.groupBy("customer_id", "_slot").agg(F.sum("_n").alias("_n"), F.sum("_amt").alias("_amt"))
        .select("customer_id", F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias("_at"), "_slot",
                F.sum("_n").over(inside).alias("_n"), money(F.sum("_amt").over(inside)).alias("_amt"))
        .filter(F.col("_n").isNotNull())
    )
    running = (
        Window.partitionBy("customer_id", "_slot").orderBy(F.col("_at").asc_nulls_first(), "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        moves.unionByName(opening)
        .withColumn("tx_in_window", F.sum("_n").over(running))
        .withColumn("amount_in_window", F.sum("_amt").over(running).cast("double"))
        .filter(F.col("_kind") == 1)
        .select("customer_id", F.timestamp_micros("_at").alias("transaction_timestamp"), "tx_in_window", "amount_in_window")
    )


def velocity(tx: DataFrame, window_seconds: int = 3600, slot_seconds: int = 300) -> DataFrame:
    """Trailing counters for every transaction."""
    return tx.join(velocity_instants(tx, window_seconds, slot_seconds), ["customer_id", "transaction_timestamp"])


def sessions(tx: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Activity sessions per customer: a pause longer than the gap starts a new one.

    Rows of one gap-wide slot always share a session, so each slot shrinks to its first and
    last time before the customer's slots are put in order.
    """
    slots = tx.groupBy("customer_id", epoch_slot("transaction_timestamp", gap_seconds).alias("_slot")).agg(
        F.min("transaction_timestamp").alias("lo"), F.max("transaction_timestamp").alias("hi"),
        F.count(F.lit(1)).alias("n"), F.sum(money("amount")).alias("amt"))
    order = Window.partitionBy("customer_id").orderBy("_slot")
    pause = F.unix_micros("lo") - F.unix_micros(F.lag("hi").over(order))
    numbered = slots.withColumn("_new", F.when(pause <= gap_seconds * 1_000_000, 0).otherwise(1)).withColumn(
        "session_no", F.sum("_new").over(order))
    return numbered.groupBy("customer_id", "session_no").agg(
        F.min("lo").alias("session_start"), F.max("hi").alias("last_seen"),
        F.sum("n").alias("transactions"), F.sum("amt").cast("double").alias("amount"),
    ).withColumn("session_end", F.timestamp_micros(F.unix_micros("last_seen") + gap_seconds * 1_000_000)).drop("last_seen")


def sliding_counts(tx: DataFrame, width: str = "1 hour", step: str = "15 minutes") -> DataFrame:
    """Transactions per customer in overlapping windows; works on a stream too."""
    return tx.groupBy(F.window("transaction_timestamp", width, step).alias("w"), "customer_id").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum(money("amount")).cast("double").alias("amount"),
    ).select("customer_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "transactions", "amount")


def top_suspects(tx: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most suspect customers of each bank.  The full tie-break lets each task
    drop all but its own first ``n`` rows per bank before the shuffle."""
    per = tx.groupBy("bank_entity", "customer_id").agg(
        F.count_if(F.col("status") == "BLOCKED").alias("blocked"),
        F.sum(F.col("fraud_score").cast("decimal(18,6)")).cast("double").alias("score_sum"))
    order = Window.partitionBy("bank_entity").orderBy(F.desc("blocked"), F.desc("score_sum"), "customer_id")
    return per.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= n)


def latest_rates(ticks: DataFrame) -> DataFrame:
    """Latest quote of each currency pair."""
    return latest_by(ticks, ["base_currency", "quote_currency"], ["timestamp", "pair_id"])


def trailing_liquidity(daily: DataFrame, days: int = 7) -> DataFrame:
    """Trailing mean and spread of the daily net flow, over the last ``days`` active days."""
    w = Window.partitionBy("bank_entity").orderBy("date").rowsBetween(-(days - 1), 0)
    net = money("net_liquidity")
    return daily.select(
        "bank_entity", "date", "net_liquidity", F.count("net_liquidity").over(w).alias("days_used"),
        F.round(ratio(F.sum(net).over(w), F.count("net_liquidity").over(w)), 4).alias("trailing_mean"),
        F.round(F.stddev_samp("net_liquidity").over(w), 4).alias("trailing_sd"))


# Ordered report pages.  Each ends with a unique key so that the cut is reproducible.

def forecast_page(forecast: DataFrame, as_of, days: int = 30, bank: str | None = None, limit: int = 1000) -> DataFrame:
    rows = by_bank(forecast.filter(F.col("forecast_date") >= days_before(ts_lit(as_of), days)), bank)
    return rows.select("bank_entity", "forecast_date", "predicted_inflow", "predicted_outflow", "net_liquidity", "is_payday",
                       "forecast_id").orderBy("bank_entity", F.desc("forecast_date"), "forecast_id").limit(limit)


def kpi_page(kpis: DataFrame, as_of, hours: int = 24, bank: str | None = None, limit: int = 500) -> DataFrame:
    rows = by_bank(kpis.filter(F.col("window_start") >= hours_before(ts_lit(as_of), hours)), bank)
    return rows.select("bank_entity", "kpi_name", "kpi_value", "window_start", "window_end").orderBy(
        F.desc("window_start"), "bank_entity", "kpi_name").limit(limit)


def branch_page(rolled: DataFrame, limit: int = 500) -> DataFrame:
    return rolled.orderBy(F.desc("total_transactions"), "bank_entity", "branch_id", "channel_type").limit(limit)


def fx_page(ticks: DataFrame, limit: int = 100) -> DataFrame:
    return ticks.orderBy(F.desc("timestamp"), "pair_id").limit(limit)


def top_customers(tx: DataFrame, as_of, days: int = 7, limit: int = 20) -> DataFrame:
    """Customers with the greatest accumulated score of the last days."""
    return since_days(tx, as_of, days).groupBy("customer_id").agg(
        F.sum(F.col("fraud_score").cast("decimal(18,6)")).cast("double").alias("score_sum"), F.count(F.lit(1)).alias("n"),
    ).orderBy(F.desc("score_sum"), "customer_id").limit(limit)
