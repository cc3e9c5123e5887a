"""Generated inputs: calendar days and synthetic transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankweave import schemas as S
from bankweave.functions import date_lit, is_payday, is_weekend, ts_lit

# The shape of the synthetic data.
FRAUD_SHARE = 0.03
STATUS_WEIGHTS = [("APPROVED", 85), ("REJECTED", 5), ("PENDING", 10)]
UNIFORM_AMOUNTS = {"WITHDRAWAL": (10, 500), "PAYMENT": (5, 2000), "DEPOSIT": (50, 10000)}
TRANSFER_LOGNORMAL = (6, 2)


def mark_days(days: DataFrame, holidays: list[str], paydays: list[int] | None = None,
              include_last_day: bool = False) -> DataFrame:
    """Holiday, payday and weekend flags for a column ``date``."""
    return (
        days.withColumn("is_holiday", F.col("date").cast("string").isin(*holidays) if holidays else F.lit(False))
        .withColumn("is_payday", is_payday("date", paydays, include_last_day))
        .withColumn("is_weekend", is_weekend("date"))
        .withColumn("day_of_week", F.dayofweek("date"))
    )


def calendar_of(df: DataFrame, ts: str, holidays: list[str] | None = None, extra_days: int = 0, **kw) -> DataFrame:
    """Calendar over the span a table covers, and ``extra_days`` beyond it."""
    span = df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", F.date_add("hi", extra_days))).alias("date"))
    return mark_days(days, holidays or [], **kw)


def _choice(options: list[str], u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.floor(u * len(options)) + 1).cast("int"))


def _account(bank: Column, u: Column) -> Column:
    return F.concat(F.upper(F.substring(bank, 1, 3)), F.lit("-"), F.floor(u * 90_000_000 + 10_000_000).cast("string"))


def synthetic(base: DataFrame, as_of, days_back: int = 0, seed: int = 0, banks: list[str] | None = None) -> DataFrame:
    """One synthetic transaction per row of ``base`` (a column ``id``).

    All draws are functions of (seed, id), so retries and any partitioning give the same rows.
    """
    def u(name: str) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(name), F.col("id")), 11)
        return bits.cast("double") / F.lit(float(2**53))

    banks = banks or S.BANKS
    df = base.select(
        "id", _choice(banks, u("bank")).alias("bank_entity"), _choice(banks, u("dest")).alias("destination_bank"),
        _choice(S.TRANSACTION_TYPES, u("type")).alias("transaction_type"), _choice(S.CHANNELS, u("channel")).alias("channel"),
        (u("fraud") < FRAUD_SHARE).cast("int").alias("is_fraud"),
    )
    mean, spread = TRANSFER_LOGNORMAL
    # Box-Muller: two uniform draws give one normal draw.
    normal = F.sqrt(-2 * F.ln(F.lit(1.0) - u("n1"))) * F.cos(F.lit(6.283185307179586) * u("n2"))
    amount = F.exp(F.lit(float(mean)) + F.lit(float(spread)) * normal)
    for kind, (low, high) in UNIFORM_AMOUNTS.items():
        amount = F.when(F.col("transaction_type") == kind, F.lit(float(low)) + u("amount") * float(high - low)).otherwise(amount)
    weight, weighted = 0.0, None
    for status, share in STATUS_WEIGHTS:
        weight += share / 100
        weighted = F.when(u("status") < weight, status) if weighted is None else weighted.when(u("status") < weight, status)
    fraud = F.col("is_fraud") == 1
    seconds = F.floor(u("day") * (days_back + 1)) * 86400 + F.floor(u("second") * 86400)
    branch = F.concat(F.lit("SUC-"), F.upper(F.substring("bank_entity", 1, 3)), F.lit("-"),
                      F.lpad((F.floor(u("branch") * 50) + 1).cast("string"), 3, "0"))
    return df.select(
        stable_uuid(seed).alias("transaction_id"), "bank_entity",
        F.concat(F.lit("CLI-"), F.floor(u("customer") * 900_000 + 100_000).cast("string")).alias("customer_id"),
        "transaction_type", F.round(amount, 2).alias("amount"), _choice(S.CURRENCIES, u("currency")).alias("currency"),
        _account(F.col("bank_entity"), u("src")).alias("source_account"),
        _account(F.col("destination_bank"), u("dst")).alias("destination_account"), "destination_bank", "channel",
        F.when(fraud, "BLOCKED").otherwise(weighted).alias("status"),
        F.round(F.when(fraud, 0.8 + 0.2 * u("score")).otherwise(0.3 * u("score")), 4).alias("fraud_score"),
        F.round(4.5 + 6.5 * u("lat"), 6).alias("latitude"), F.round(-75.0 + 8.0 * u("lon"), 6).alias("longitude"),
        F.when(F.col("channel") == "APP", F.concat(F.lit("DEV-"), F.floor(u("device") * 9000 + 1000).cast("string"))).alias("device_id"),
        F.timestamp_seconds(F.unix_seconds(ts_lit(as_of)) - seconds).alias("transaction_timestamp"),
        F.when(F.col("channel") != "APP", branch).alias("branch_id"), "is_fraud",
    )


def stable_uuid(seed: int) -> Column:
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string")).cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])
