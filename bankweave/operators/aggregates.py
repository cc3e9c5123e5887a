"""Grouped reports.  Sums are taken on exact cents and leave as doubles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankweave import schemas as S
from bankweave.functions import (
    days_before, is_inflow, is_payday, is_weekend, money, ratio, stable_id, total, ts_lit,
)
from bankweave.sources.files import by_bank, on_day


def _n():
    return F.count(F.lit(1))


def _is(status: str):
    return F.col("status") == status


def movement_trends(tx: DataFrame, approx_customers: bool = False, rsd: float = 0.02) -> DataFrame:
    """Daily movement per bank; the approximate form replaces the distinct pass by a sketch."""
    customers = F.approx_count_distinct("customer_id", rsd) if approx_customers else F.count_distinct("customer_id")
    return (
        tx.withColumn("date", F.to_date("transaction_timestamp"))
        .groupBy("bank_entity", "date")
        .agg(
            _n().alias("total_transactions"), total("amount").alias("total_amount"), customers.alias("unique_customers"),
            F.count_if(_is("APPROVED")).alias("approved_count"), F.count_if(_is("BLOCKED")).alias("blocked_count"),
        )
        .withColumn("day_of_week", F.dayofweek("date"))
        .withColumn("is_weekend", is_weekend("date"))
        .withColumn("avg_amount", ratio(F.col("total_amount"), F.col("total_transactions")))
        .withColumn("approval_rate", ratio(F.col("approved_count"), F.col("total_transactions")))
    )


def daily_liquidity(tx: DataFrame, paydays: list[int] | None = None) -> DataFrame:
    """Inflow, outflow and net per bank and day."""
    amount, zero = money("amount"), money(F.lit(0))
    inflow = F.sum(F.when(is_inflow(), amount).otherwise(zero))
    outflow = F.sum(F.when(~is_inflow(), amount).otherwise(zero))
    return (
        tx.groupBy("bank_entity", F.to_date("transaction_timestamp").alias("date"))
        .agg(inflow.cast("double").alias("total_inflow"), outflow.cast("double").alias("total_outflow"),
             F.sum(F.when(is_inflow(), amount).otherwise(-amount)).cast("double").alias("net_liquidity"))
        .withColumn("day_of_week", F.dayofweek("date"))
        .withColumn("day_of_month", F.dayofmonth("date"))
        .withColumn("is_payday", is_payday("date", paydays))
    )


def branch_metrics(tx: DataFrame) -> DataFrame:
    """Volume per bank, branch, channel and day.

    ``last_active_hour`` is the greatest hour seen; ``peak_hour`` the busiest (ties: the earliest).
    """
    median = F.percentile_approx("amount", 0.5)
    hour = F.hour("transaction_timestamp")
    return (
        tx.filter(F.col("branch_id").isNotNull())
        .groupBy("bank_entity", "branch_id", F.col("channel").alias("channel_type"),
                 F.to_date("transaction_timestamp").alias("metric_date"))
        .agg(_n().alias("total_transactions"), total("amount").alias("total_amount"), median.alias("median_amount"),
             F.max(hour).alias("last_active_hour"), F.mode(hour, True).alias("peak_hour"))
    )


def branch_utilization(branches: DataFrame) -> DataFrame:
    """Branch-day volume over the busiest branch of that bank and day, with its load class.

    The windows run over one row per branch and day, so nothing is read twice.
    """
    per_branch = branches.groupBy("bank_entity", "metric_date", "branch_id").agg(
        F.sum("total_transactions").alias("branch_transactions"))
    day = Window.partitionBy("bank_entity", "metric_date")
    rated = per_branch.withColumn("utilization_rate", ratio(F.col("branch_transactions"), F.max("branch_transactions").over(day)))
    return rated.withColumns({"low": F.percentile("utilization_rate", 0.1).over(day), "high": F.percentile("utilization_rate", 0.9).over(day)}).withColumn(
        "load_class",
        F.when(F.col("utilization_rate") >= F.col("high"), "CONGESTED")
        .when(F.col("utilization_rate") <= F.col("low"), "UNDERUSED").otherwise("NORMAL"),
    ).drop("low", "high")


def branch_volume(tx: DataFrame) -> DataFrame:
    """Rows of the branch volume table: utilization filled in, waiting time not (there is no input for it).

    Windows over the aggregated rows, a few for each branch and day, give the rate; the transactions are read once.
    """
    day = Window.partitionBy("bank_entity", "metric_date")
    branch = Window.partitionBy("bank_entity", "metric_date", "branch_id")
    metrics = branch_metrics(tx).withColumn("_branch", F.sum("total_transactions").over(branch))
    metrics = metrics.withColumn("utilization_rate", ratio(F.col("_branch"), F.max("_branch").over(day)))
    return metrics.select(
        stable_id("bank_entity", "branch_id", "channel_type", "metric_date").alias("metric_id"),
        "bank_entity", "branch_id", "channel_type", F.col("metric_date").cast("timestamp").alias("metric_date"),
        "total_transactions", "total_amount", F.lit(None).cast("double").alias("avg_wait_time_minutes"),
        "utilization_rate", "peak_hour",
    )


def daily_summary(tx: DataFrame, day, bank: str | None = None) -> DataFrame:
    """One day per bank: volumes, status counts, average score, first and last transaction."""
    score = F.col("fraud_score").cast("decimal(18,6)")
    return (
        by_bank(on_day(tx, day), bank).groupBy("bank_entity")
        .agg(
            _n().alias("total_transactions"), total("amount").alias("total_amount"),
            F.count_if(_is("APPROVED")).alias("approved"), F.count_if(_is("BLOCKED")).alias("blocked"),
            F.count_if(_is("PENDING")).alias("pending"),
            ratio(F.sum(score), F.count("fraud_score")).alias("avg_fraud_score"),
            F.min("transaction_timestamp").alias("first_txn"), F.max("transaction_timestamp").alias("last_txn"),
        )
        .withColumn("avg_amount", ratio(F.col("total_amount"), F.col("total_transactions")))
    )


def branch_rollup(branch_table: DataFrame, as_of, days: int = 7, bank: str | None = None) -> DataFrame:
    """Branch table summed over the last ``days`` days."""
    recent = by_bank(branch_table.filter(F.col("metric_date") >= days_before(ts_lit(as_of), days)), bank)
    rate = F.col("utilization_rate").cast("decimal(18,9)")
    return recent.groupBy("bank_entity", "branch_id", "channel_type").agg(
        F.sum("total_transactions").alias("total_transactions"), total("total_amount").alias("total_amount"),
        ratio(F.sum(rate), F.count("utilization_rate")).alias("avg_utilization"),
        F.avg("avg_wait_time_minutes").alias("avg_wait_time"),
    )


def kpi_counts(tx: DataFrame, width: str = "1 hour") -> DataFrame:
    """Counts per bank and tumbling window; works on a stream too."""
    latency = F.unix_millis("processing_timestamp") - F.unix_millis("transaction_timestamp")
    return tx.groupBy(F.window("transaction_timestamp", width).alias("w"), "bank_entity").agg(
        _n().alias("n"), F.sum(latency).alias("latency_ms"),
        F.count_if(_is("BLOCKED")).alias("blocked"), F.count_if(_is("APPROVED")).alias("approved"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
             "bank_entity", "n", "latency_ms", "blocked", "approved")


def kpi_rows(counts: DataFrame) -> DataFrame:
    """Long KPI table: one row per window, bank and KPI name."""
    seconds = F.unix_seconds("window_end") - F.unix_seconds("window_start")
    wide = counts.select(
        "bank_entity", "window_start", "window_end",
        F.to_json(F.struct(F.col("n").alias("transactions"))).alias("dimensions"),
        ratio(F.col("n"), seconds).alias("TPS"), ratio(F.col("latency_ms"), F.col("n")).alias("avg_latency"),
        ratio(F.col("blocked"), F.col("n")).alias("fraud_rate"), ratio(F.col("approved"), F.col("n")).alias("approval_rate"),
    )
    keys = ["bank_entity", "window_start", "window_end", "dimensions"]
    long = wide.unpivot(keys, S.KPI_NAMES, "kpi_name", "kpi_value")
    return long.withColumn("kpi_id", stable_id("bank_entity", "kpi_name", F.unix_micros("window_start")))


def consolidated_report(tx: DataFrame, report_type: str = "DAILY") -> DataFrame:
    """Daily report per bank with a per-type breakdown as JSON."""
    millis = F.unix_millis("processing_timestamp") - F.unix_millis("transaction_timestamp")
    blocked = F.sum(F.when(_is("BLOCKED"), money("amount")))
    per_type = tx.groupBy("bank_entity", F.to_date("transaction_timestamp").alias("report_date"), "transaction_type").agg(
        _n().alias("n"), F.sum(money("amount")).alias("amount"), F.count_if(_is("BLOCKED")).alias("b"), blocked.alias("b_amount"), F.sum(millis).alias("ms"))
    # Every type that occurs, the catalog's or not, in order of name.
    kinds = F.sort_array(F.collect_list(F.when(F.col("transaction_type").isNotNull(), F.struct("transaction_type", "n"))))
    grouped = per_type.groupBy("bank_entity", "report_date").agg(
        F.sum("n").alias("total_transactions"), F.sum("amount").cast("double").alias("total_amount"), F.sum("b").alias("fraud_blocked_count"),
        F.coalesce(F.sum("b_amount").cast("double"), F.lit(0.0)).alias("fraud_blocked_amount"),
        ratio(F.sum("ms"), F.sum("n")).alias("avg_processing_time_ms"), F.map_from_entries(kinds).alias("kinds"),
    )
    return grouped.select(
        stable_id(F.lit(report_type), "bank_entity", "report_date").alias("report_id"), F.lit(report_type).alias("report_type"),
        "bank_entity", F.col("report_date").cast("timestamp").alias("report_date"), "total_transactions", "total_amount",
        "fraud_blocked_count", "fraud_blocked_amount", "avg_processing_time_ms", F.to_json("kinds").alias("details"),
    )


def average_score(tx: DataFrame) -> DataFrame:
    return tx.groupBy("bank_entity").agg(
        ratio(F.sum(F.col("fraud_score").cast("decimal(18,6)")), F.count("fraud_score")).alias("avg_fraud_score"))


def blocked_by_hour(tx: DataFrame) -> DataFrame:
    return tx.groupBy(F.date_trunc("hour", "transaction_timestamp").alias("hour_start")).agg(
        F.count_if(_is("BLOCKED")).alias("blocked"),
        F.coalesce(F.sum(F.when(_is("BLOCKED"), money("amount"))).cast("double"), F.lit(0.0)).alias("blocked_amount"))


def branch_heat_map(tx: DataFrame) -> DataFrame:
    """Branch by channel volume; channels are the closed catalog, so no pass is needed to find them."""
    kinds = S.CHANNELS
    return tx.filter(F.col("branch_id").isNotNull()).groupBy("branch_id").pivot("channel", kinds).agg(_n()).na.fill(0, kinds)


def regulator_totals(tx: DataFrame) -> DataFrame:
    """Per bank and for the whole network.  Rows are merged per bank before they are expanded."""
    per_bank = tx.groupBy("bank_entity").agg(
        _n().alias("n"), F.sum(money("amount")).alias("cents"), F.count_if(_is("BLOCKED")).alias("b"))
    return per_bank.rollup("bank_entity").agg(
        F.grouping("bank_entity").cast("int").alias("is_network"), F.sum("n").alias("total_transactions"),
        F.sum("cents").cast("double").alias("total_amount"), F.sum("b").alias("blocked_count"),
    ).withColumn("bank_entity", F.when(F.col("is_network") == 1, "ALL").otherwise(F.col("bank_entity")))


def channel_type_cube(tx: DataFrame) -> DataFrame:
    """Channel by type, with all subtotals.  Rows are merged to the finest level before they are expanded."""
    finest = tx.groupBy("channel", "transaction_type").agg(_n().alias("n"), F.sum(money("amount")).alias("cents"))
    return finest.cube("channel", "transaction_type").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("n").alias("total_transactions"),
        F.sum("cents").cast("double").alias("total_amount"))


def reconcile(closes: DataFrame, tx: DataFrame) -> DataFrame:
    """Declared daily closes against the computed totals of the same bank and day."""
    computed = tx.groupBy("bank_entity", F.to_date("transaction_timestamp").alias("close_date")).agg(
        _n().alias("computed_count"), total("amount").alias("computed_amount"))
    declared = closes.select("bank_entity", F.to_date("extraction_date").alias("close_date"),
                             F.col("total_count").alias("declared_count"), F.col("total_amount").alias("declared_amount"))
    none = F.lit(0)
    return declared.join(computed, ["bank_entity", "close_date"], "full_outer").withColumn(
        "count_diff", F.coalesce("declared_count", none) - F.coalesce("computed_count", none)
    ).withColumn(
        "amount_diff", (F.coalesce(money("declared_amount"), money(none)) - F.coalesce(money("computed_amount"), money(none))).cast("double")
    ).withColumn("matches", (F.col("count_diff") == 0) & (F.col("amount_diff") == 0))
