"""Joins: enrichment, cross-bank fraud, calendar, market rates, set operations and lookups.

No side is hinted for broadcast.  The planner broadcasts what it measures as small and
otherwise shuffles on the key; adaptive execution splits a skewed partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankweave.functions import cache_key, epoch_slot, last_txn_key, money, ratio, ts_lit
from bankweave.operators.scale import asof_last, latest_by
from bankweave.session import stage


def enrich(tx: DataFrame, profiles: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Transactions with what is known of their customer."""
    return tx.join(profiles, keys or ["customer_id"], "left")


def forecast_vs_realised(forecast: DataFrame, realised: DataFrame) -> DataFrame:
    """Predicted and realised flows side by side, with errors; rows missing on one side stay."""
    return forecast.join(realised, ["bank_entity", "date"], "full_outer").withColumn(
        "inflow_error", F.col("predicted_inflow") - F.col("total_inflow")
    ).withColumn("outflow_error", F.col("predicted_outflow") - F.col("total_outflow"))


def customer_bank_activity(tx: DataFrame) -> DataFrame:
    blocked = F.col("status") == "BLOCKED"
    return tx.groupBy("customer_id", "bank_entity").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(blocked).alias("blocked"),
        F.min(F.when(blocked, F.col("transaction_timestamp"))).alias("first_blocked_ts"),
        F.max(F.when(F.col("status").isin("BLOCKED", "PENDING"), F.col("transaction_timestamp"))).alias("last_flag"),
    )


def cross_bank_fraud(tx: DataFrame) -> DataFrame:
    """Every (customer, bank) where the customer was blocked at another bank.

    Rows are merged to one per customer and bank before they meet, so a customer brings at
    most one row per bank of the closed catalog, and one row per flagged bank comes out
    instead of one per pair of banks.
    """
    act = customer_bank_activity(tx)
    mine = Window.partitionBy("customer_id")
    own = F.when(F.col("blocked") > 0, F.struct(F.col("bank_entity").alias("bank"), F.col("blocked"), F.col("first_blocked_ts").alias("ts")))
    sources = F.collect_list(own).over(mine)
    elsewhere = F.filter(sources, lambda s: s.bank != F.col("bank_entity"))
    return (
        act.withColumn("_from", elsewhere).filter(F.size("_from") > 0)
        .select(
            "customer_id", F.col("bank_entity").alias("flagged_bank"), F.col("n").alias("transactions_here"),
            F.col("blocked").alias("blocked_here"),
            F.array_join(F.array_sort(F.transform("_from", lambda s: s.bank)), ",").alias("blocked_at"),
            F.aggregate("_from", F.lit(0).cast("bigint"), lambda a, s: a + s.blocked).alias("blocked_elsewhere"),
            F.array_min(F.transform("_from", lambda s: s.ts)).alias("first_blocked_ts"),
        )
    )


def suspects(tx: DataFrame) -> DataFrame:
    """Customers with a blocked transaction, and when the first one was."""
    return tx.filter(F.col("status") == "BLOCKED").groupBy("customer_id").agg(
        F.min("transaction_timestamp").alias("first_blocked_ts"))


def after_suspicion(tx: DataFrame) -> DataFrame:
    """Transactions a customer made after their first blocked one."""
    s = suspects(tx).withColumnRenamed("customer_id", "suspect_id")
    return tx.join(
        s, (F.col("customer_id") == F.col("suspect_id")) & (F.col("transaction_timestamp") > F.col("first_blocked_ts")), "left_semi")


def follow_ups(tx: DataFrame, window_seconds: int = 3600) -> DataFrame:
    """Transactions within ``window_seconds`` after the same customer was blocked at another bank.

    Blocked rows shrink to their first and last time per customer, slot and bank.  Slots are as
    wide as the window, so a row needs only its own slot (was the first at or before it?) and
    the one before (was the last late enough?), at most two rows per bank.
    """
    blocked = (
        tx.filter(F.col("status") == "BLOCKED")
        .groupBy("customer_id", epoch_slot("transaction_timestamp", window_seconds).alias("slot"), "bank_entity")
        .agg(F.min("transaction_timestamp").alias("lo"), F.max("transaction_timestamp").alias("hi"))
        .select(F.col("customer_id").alias("b_customer"), F.col("bank_entity").alias("b_bank"), "lo", "hi",
                F.posexplode(F.array("slot", F.col("slot") + 1)).alias("later", "b_slot"))
    )
    ts = F.col("transaction_timestamp")
    in_reach = F.when(F.col("later") == 0, F.col("lo") <= ts).otherwise(
        F.col("hi") >= ts - F.make_dt_interval(secs=F.lit(float(window_seconds)).cast("decimal(18,6)")))
    hit = (F.col("customer_id") == F.col("b_customer")) & (F.col("_slot") == F.col("b_slot")) & (
        F.col("bank_entity") != F.col("b_bank")) & in_reach
    return tx.withColumn("_slot", epoch_slot(ts, window_seconds)).join(blocked, hit, "left_semi").drop("_slot")


def new_rows(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(target.select(*keys), keys, "left_anti")


def with_calendar(df: DataFrame, calendar: DataFrame, date_col: str = "date") -> DataFrame:
    cal = calendar.select(F.col("date").alias(date_col), "is_holiday", "is_payday")
    return df.join(cal, date_col, "left")


def fx_normalise(tx: DataFrame, ticks: DataFrame, home: str = "DLD", **kw) -> DataFrame:
    """Amounts in the home currency, at the last rate at or before each transaction."""
    rates = ticks.filter(F.col("quote_currency") == home).select(
        F.col("base_currency").alias("currency"), F.col("timestamp").alias("tick_ts"), "rate")
    return asof_last(
        tx, rates, key="currency", fact_ts="transaction_timestamp", tick_ts="tick_ts", value="rate",
        row_id="transaction_id", **kw,
    ).withColumn("amount_home", F.col("amount") * F.col("rate"))


def rates_on(df: DataFrame, rates: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows keyed by ``country_code`` and a day, with the rate in effect that day: a row for each rate type, one without rate if there is none.

    The days that occur for a country, not the rows, are put in order with its rates, and each takes the last rate at or before
    it; rows then find their rates by country and day alone, so a country with much of the data is spread over its days.
    """
    days = df.select(F.col("country_code").alias("_cc"), F.col(date_col).cast("date").alias("_day")).filter("_cc IS NOT NULL AND _day IS NOT NULL").distinct()
    kinds = rates.select(F.col("country_code").alias("_cc"), "rate_type").distinct()
    held = F.struct("rate_value", "effective_date")
    marks = rates.select(F.col("country_code").alias("_cc"), "rate_type", F.col("effective_date").cast("date").alias("_day"), F.lit(0).alias("_ask"), held.alias("_rate"))
    asked = days.join(kinds, "_cc").select("_cc", "rate_type", "_day", F.lit(1).alias("_ask"), F.lit(None).cast(marks.schema["_rate"].dataType).alias("_rate"))
    upto = Window.partitionBy("_cc", "rate_type").orderBy("_day", "_ask", F.col("_rate.rate_value")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = marks.unionByName(asked).withColumn("_rate", F.last("_rate", ignorenulls=True).over(upto)).filter((F.col("_ask") == 1) & F.col("_rate").isNotNull())
    found = found.select("_cc", "_day", "rate_type", "_rate.rate_value", "_rate.effective_date")
    return df.join(found, (F.col("country_code") == F.col("_cc")) & (F.col(date_col).cast("date") == F.col("_day")), "left").drop("_cc", "_day")


def outside_catalog(df: DataFrame, catalog: DataFrame, column: str) -> DataFrame:
    """Rows whose value is not in a catalog table."""
    return df.join(catalog.select(column), column, "left_anti")


# Profile, cache and lookup views.

def profile_snapshot(tx: DataFrame) -> DataFrame:
    """Wide profile row per bank and customer: the cells of its latest transaction."""
    last = latest_by(
        tx.select("bank_entity", "customer_id", "transaction_timestamp", "transaction_id", "amount",
                  "transaction_type", "channel", "fraud_score", "status"),
        ["bank_entity", "customer_id"], ["transaction_timestamp", "transaction_id"])
    return last.select(
        F.concat_ws("#", "bank_entity", "customer_id").alias("row_key"), "bank_entity", "customer_id",
        F.struct(F.col("amount").cast("string").alias("last_transaction_amount"),
                 F.col("transaction_type").alias("last_transaction_type"),
                 F.col("channel").alias("last_channel")).alias("financial_data"),
        F.struct(F.coalesce("fraud_score", F.lit(0.0)).cast("string").alias("fraud_score"),
                 F.col("status").alias("last_status")).alias("risk_score"),
        F.col("transaction_timestamp").alias("updated_at"), F.col("transaction_id").alias("updated_by"),
    )


def recent_cache(tx: DataFrame, as_of, ttl: int = 3600, ts: str = "processing_timestamp") -> DataFrame:
    """Entries still alive at ``as_of``: keyed JSON of the transactions of the last ``ttl`` seconds."""
    now = ts_lit(as_of)
    live = (F.col(ts) > now - F.make_dt_interval(secs=F.lit(ttl).cast("decimal(18,6)"))) & (F.col(ts) <= now)
    return tx.filter(live).select(
        cache_key().alias("cache_key"), "transaction_id", "status", F.to_json(F.struct(*tx.columns)).alias("value"))


def last_transactions(tx: DataFrame) -> DataFrame:
    """Latest transaction per bank and customer; never expires."""
    last = latest_by(tx, ["bank_entity", "customer_id"], ["transaction_timestamp", "transaction_id"])
    return last.withColumn("cache_key", last_txn_key())


def status_lookup(requests: DataFrame, cache: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Status per requested id: the cache first, then the warehouse."""
    c = cache.select("transaction_id", F.col("status").alias("cached"))
    w = warehouse.select("transaction_id", F.col("status").alias("stored"))
    return requests.join(c, "transaction_id", "left").join(w, "transaction_id", "left").select(
        "transaction_id", F.coalesce("cached", "stored", F.lit("UNKNOWN")).alias("status"),
        F.when(F.col("cached").isNotNull(), "cache").when(F.col("stored").isNotNull(), "warehouse").otherwise("none").alias("found_in"))


# Set operations.

def merge_feeds(feeds: list[DataFrame]) -> DataFrame:
    """One flow out of several feeds, matched by column name."""
    merged = feeds[0]
    for feed in feeds[1:]:
        merged = merged.unionByName(feed, allowMissingColumns=True)
    return merged


def unified_view(hot: DataFrame, cold: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Stream rows and history, one row per id; a stream row wins over its stored copy.

    History already holds one row per id, so only the short hot side is deduplicated.
    """
    hot = latest_by(hot, [key], ["processing_timestamp"])
    return hot.unionByName(cold.join(hot.select(key), key, "left_anti"), allowMissingColumns=True)


def cross_bank_detection(tx: DataFrame, target: float = 0.9) -> DataFrame:
    """Share of multi-bank suspects that were also flagged (blocked or held) at another bank later."""
    act = stage(customer_bank_activity(tx), "activity")  # a row per customer and bank, read several times
    first = act.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("banks"),
        F.min(F.when(F.col("blocked") > 0, F.struct("first_blocked_ts", "bank_entity"))).alias("first"))
    multi = first.filter((F.col("banks") > 1) & F.col("first").isNotNull()).select(
        "customer_id", F.col("first.first_blocked_ts").alias("since"), F.col("first.bank_entity").alias("source_bank"))
    flags = act.filter(F.col("last_flag").isNotNull()).select(F.col("customer_id").alias("f_customer"), "bank_entity", "last_flag")
    hit = (F.col("customer_id") == F.col("f_customer")) & (F.col("bank_entity") != F.col("source_bank")) & (F.col("last_flag") > F.col("since"))
    found = multi.join(flags, hit, "left_semi").select("customer_id", F.lit(1).alias("hit"))
    return multi.join(found, "customer_id", "left").agg(
        F.count(F.lit(1)).alias("multi_bank_suspects"), F.count("hit").alias("flagged_elsewhere"),
    ).withColumn("detection_rate", ratio(F.col("flagged_elsewhere"), F.col("multi_bank_suspects"))).withColumn(
        "meets_target", F.coalesce(F.col("detection_rate") >= target, F.lit(False)))


def home_totals(tx_home: DataFrame) -> DataFrame:
    """Totals per bank in the home currency, and what had no rate yet."""
    cents: Column = F.sum(money("amount_home")).cast("double")
    return tx_home.groupBy("bank_entity", "currency").agg(
        F.count(F.lit(1)).alias("n"), F.count("rate").alias("priced"), cents.alias("total_home"))
