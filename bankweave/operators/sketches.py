"""Mergeable counts and medians: a sketch per bank and day is stored once and rolled up without reading transactions again.

Distinct customers use theta sketches, which allow unions, intersections and differences; amounts use KLL sketches.  Both
hold everything exactly as long as a group has few values (``2 ** LG_ENTRIES`` customers, ``KLL_K`` amounts).  Beyond that, the relative error
of a count is about 1 / sqrt(2 ** LG_ENTRIES) (standard deviation), and a median's rank is off by ``rank_error(KLL_K)`` at most with 99 per cent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankweave.functions import days_before, total, ts_lit
from bankweave.operators.tables import write_partitioned
from bankweave.session import path_exists, stage
from bankweave.sources.files import by_bank

LG_ENTRIES = 14
KLL_K = 400


def count_error(lg: int = LG_ENTRIES, deviations: float = 3.0) -> float:
    """Relative error that a distinct count stays within."""
    return deviations / float(2**lg) ** 0.5


def rank_error(k: int = KLL_K) -> float:
    """Error of a quantile's rank that a sketch of this size stays within, with 99 per cent."""
    return 2.296 / k**0.9021


# Distinct customers.

def customer_sketches(tx: DataFrame, lg: int = LG_ENTRIES) -> DataFrame:
    """Transactions, amount and customer sketch per bank and day; tasks merge before the shuffle, so a busy bank is spread."""
    return tx.groupBy("bank_entity", F.to_date("transaction_timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("total_transactions"), total("amount").alias("total_amount"),
        F.theta_sketch_agg("customer_id", lg).alias("customers"))


def append_sketches(rows: DataFrame, path: str) -> None:
    """Add days; a day that is there already is replaced, so a repeated run changes nothing.

    The table is partitioned by month, as it has few rows a day; the months that get new days are written anew, from a staged copy.
    """
    spark, month = rows.sparkSession, F.date_format("date", "yyyy-MM")
    rows = stage(rows.withColumn("sketch_month", month), "sketches")
    if path_exists(spark, path):
        held = spark.read.schema(rows.schema).parquet(path).join(rows.select("sketch_month").distinct(), "sketch_month", "left_semi")
        rows = stage(rows.unionByName(held.join(rows.select("date").distinct(), "date", "left_anti")), "sketches")
    write_partitioned(rows, path, ["sketch_month"], "overwrite")


def estimate(sketch: Column | str) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0).cast("bigint"))


def customers_by(sketches: DataFrame, period: str = "month", lg: int = LG_ENTRIES) -> DataFrame:
    """Per bank and period (a unit of ``date_trunc``): customers, and how many of them came, stayed and went since the bank's period before.

    The period before is the last one in which the bank was active.  Only sketches are read: one row per bank and day.
    """
    start = F.date_trunc(period, "date").cast("date")
    rolled = sketches.groupBy("bank_entity", start.alias("period")).agg(
        F.sum("total_transactions").alias("total_transactions"), F.theta_union_agg("customers", lg).alias("customers"))
    before = F.lag("customers").over(Window.partitionBy("bank_entity").orderBy("period"))
    both = rolled.withColumn("before", before)
    first = F.col("before").isNull()
    return both.select(
        "bank_entity", "period", "total_transactions", estimate("customers").alias("unique_customers"),
        F.when(first, estimate("customers")).otherwise(estimate(F.theta_difference("customers", "before"))).alias("gained"),
        F.when(first, 0).otherwise(estimate(F.theta_intersection("customers", "before"))).cast("bigint").alias("returning"),
        F.when(first, 0).otherwise(estimate(F.theta_difference("before", "customers"))).cast("bigint").alias("lost"))


def network_customers(sketches: DataFrame, period: str = "month", lg: int = LG_ENTRIES) -> DataFrame:
    """Customers of the whole network per period, and how many relations with banks they have between them."""
    start = F.date_trunc(period, "date").cast("date")
    per_bank = sketches.groupBy(start.alias("period"), "bank_entity").agg(F.theta_union_agg("customers", lg).alias("customers"))
    return per_bank.groupBy("period").agg(
        F.count("bank_entity").alias("banks"), estimate(F.theta_union_agg("customers", lg)).alias("unique_customers"), F.sum(estimate("customers")).alias("relations"))


# Medians.

def amount_sketches(tx: DataFrame, k: int = KLL_K) -> DataFrame:
    """Volume and amount sketch per bank, branch, channel and day."""
    return tx.filter(F.col("branch_id").isNotNull()).groupBy(
        "bank_entity", "branch_id", F.col("channel").alias("channel_type"), F.to_date("transaction_timestamp").alias("date")
    ).agg(F.count(F.lit(1)).alias("total_transactions"), total("amount").alias("total_amount"), F.kll_sketch_agg_double(F.col("amount").cast("double"), k).alias("amounts"))


def median(sketch: Column | str) -> Column:
    """Least amount that at least half of the amounts are at or under; null without amounts."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(0.5)))


def branch_medians(sketches: DataFrame, as_of=None, days: int = 7, by: tuple[str, ...] = ("bank_entity", "branch_id", "channel_type"), bank: str | None = None) -> DataFrame:
    """Volume and median amount of the last ``days`` days (of all days without ``as_of``), out of the daily sketches."""
    if as_of is not None:
        sketches = sketches.filter(F.col("date") >= days_before(ts_lit(as_of), days))
    merged = by_bank(sketches, bank).groupBy(*by).agg(
        F.sum("total_transactions").alias("total_transactions"), total("total_amount").alias("total_amount"), F.kll_merge_agg_double("amounts").alias("amounts"))
    return merged.select(*by, "total_transactions", "total_amount", median("amounts").alias("median_amount"))
