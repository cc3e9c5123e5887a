"""The three entry points: the daily batch, the message stream and the report functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bankweave.functions import days_before, ts_lit
from bankweave.operators import aggregates, predict, tables, validate, windows
from bankweave.operators.scale import latest_by
from bankweave.session import size_shuffles, stage
from bankweave.sources import files
from bankweave.streaming import flows


def daily_batch(spark: SparkSession, history: str, out: str, as_of, lookback_days: int = 90, train: bool = True, **gbt) -> dict:
    """Load the look-back window once, then write trends, liquidity, model and branch volumes.

    The window is staged as Parquet in the shared folder: each step then reads only its own
    columns, nothing has to fit in memory, and a lost executor costs no second CSV pass.
    """
    size_shuffles(spark, history)
    seen = Observation("history")
    flagged = files.read_history_flagged(spark, history).observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(F.size("gaps") > 0).alias("incomplete"))
    tx = stage(files.lookback(flagged.filter(F.size("gaps") == 0).drop("gaps"), as_of, lookback_days), "window")
    result = {**seen.get, "loaded": tx.count()}
    tables.write_partitioned(aggregates.movement_trends(tx), f"{out}/movement_trends", ["date"], "overwrite")
    # A day that the window cuts would replace a whole one written before.
    whole = F.to_date(days_before(ts_lit(as_of), lookback_days) + F.expr("INTERVAL 1 DAY - INTERVAL 1 MICROSECOND"))
    tables.append_liquidity(aggregates.daily_liquidity(tx).filter(F.col("date") >= whole), f"{out}/liquidity_forecast", as_of)
    if train:
        model, auc, counts = predict.train_fraud_model(tx, **gbt)
        result |= {"auc": auc, "model": tables.save_model(model, out, as_of), **counts}
    tables.append_branches(aggregates.branch_volume(tx).filter(F.to_date("metric_date") >= whole), f"{out}/branch_volume_metrics")
    return result


def retry_quarantine(spark: SparkSession, quarantine: str, table: str, as_of, banks: list[str] | None = None) -> None:
    """Try every due message again: what passes now is stored, what fails gets its next attempt.

    The quarantine is append-only.  A message stands where its latest attempt left it, and one
    with no errors left is closed.
    """
    log = spark.read.parquet(quarantine).drop("failed_day")
    keyed = log.withColumn("message_id", F.sha2("raw", 256))
    standing = latest_by(keyed, ["message_id"], ["attempt"]).filter(F.size("errors") > 0).drop("message_id")
    due = validate.due(standing, as_of).select("raw", "attempt", "failed_at")
    # A defaulted time is that of the failure, which a second run finds again, and not that of the retry.
    tried = stage(validate.storable(due, F.col("failed_at"), banks), "retry")
    tables.append_new(tried.filter(F.size("errors") == 0).drop("raw", "_raw", "errors", "attempt", "failed_at"), table)
    after = tried.select(F.col("_raw").alias("raw"), "errors", (F.col("attempt") + 1).alias("attempt"), ts_lit(as_of).alias("failed_at"))
    tables.append_quarantine(after, quarantine)


def message_stream(spark: SparkSession, source: str, root: str, sinks=flows.SINKS, banks: list[str] | None = None,
                   available_now: bool = True) -> list:
    """Start the scoring query and the quarantine query over a folder of JSON messages.

    Every message ends in one of the two, however late it is and whatever its own clock says.
    """
    return start_message_queries(files.read_stream(spark, source), root, sinks, banks, available_now)


def start_message_queries(raw: DataFrame, root: str, sinks=flows.SINKS, banks: list[str] | None = None, available_now: bool = True) -> list:
    good, bad = flows.split_stream(raw, banks)
    return [
        flows.start_multi_sink(flows.dedup(good), root, sinks, available_now=available_now),
        flows.start(bad, f"{root}/quarantine", f"{root}/quarantine_checkpoint", available_now=available_now),
    ]


def liquidity_report(forecast: DataFrame, as_of, bank: str | None = None, days: int = 30) -> DataFrame:
    return windows.forecast_page(forecast, as_of, int(days), bank)


def kpi_report(kpis: DataFrame, as_of, bank: str | None = None, hours: int = 24) -> DataFrame:
    return windows.kpi_page(kpis, as_of, int(hours), bank)


def summary_report(tx: DataFrame, day, bank: str | None = None) -> DataFrame:
    return aggregates.daily_summary(tx, day, bank).orderBy("total_transactions", "bank_entity", ascending=[False, True])


def branch_report(branches: DataFrame, as_of, bank: str | None = None, days: int = 7) -> DataFrame:
    return windows.branch_page(aggregates.branch_rollup(branches, as_of, int(days), bank))


def fx_report(ticks: DataFrame) -> DataFrame:
    return windows.fx_page(ticks)
