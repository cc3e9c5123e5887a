"""Column expressions shared by the batch and the streaming jobs.

All of them are built-in expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankweave.schemas import AMOUNT, INFLOW_TYPES, PAYDAYS

# The score bounds (both strict) and the accepted number format.
BLOCK_ABOVE = 0.85
REVIEW_ABOVE = 0.70
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(moment: datetime | date | str) -> Column:
    return F.lit(str(moment)).cast("timestamp")


def date_lit(day: date | str) -> Column:
    return F.lit(str(day)).cast("date")


def days_before(moment: Column, days: int) -> Column:
    return moment - F.make_dt_interval(F.lit(days))


def hours_before(moment: Column, hours: int) -> Column:
    return moment - F.make_dt_interval(F.lit(0), F.lit(hours))


def money(c: Column | str) -> Column:
    """Amount in the declared numeric type, nine decimals: decimal sums do not depend on the order rows arrive in."""
    return as_col(c).cast(AMOUNT)


def total(c: Column | str) -> Column:
    """Sum of a money column, exact while summing and a double on the way out."""
    return F.sum(money(c)).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def stable_id(*cols: Column | str) -> Column:
    """Row id that a rerun reproduces."""
    return F.sha2(F.concat_ws("|", *[as_col(c).cast("string") for c in cols]), 256)


def run_id(moment: datetime | str) -> str:
    moment = datetime.fromisoformat(moment) if isinstance(moment, str) else moment
    return moment.strftime("%Y%m%d_%H%M%S")


def hash_score(column: str) -> Column:
    """md5 of an id column, read as a 128-bit number, modulo 100, over 100.

    Each half of the digest is an unsigned 64-bit number, whose last two decimal digits are its
    remainder; 2**64 mod 100 is 16, so the upper half counts 16 times.
    """
    def last_two(start: int) -> str:
        return f"cast(substr(conv(substr(md5(cast({column} AS binary)), {start}, 16), 16, 10), -2) AS int)"

    return F.expr(f"cast(({last_two(1)} * 16 + {last_two(17)}) % 100 AS double) / 100.0D")


def decide(score: str) -> Column:
    """Status for a score column; a missing score means scoring failed and waits for review."""
    return F.expr(
        f"CASE WHEN {score} IS NULL THEN 'PENDING' WHEN {score} > {BLOCK_ABOVE}D THEN 'BLOCKED' "
        f"WHEN {score} > {REVIEW_ABOVE}D THEN 'PENDING' ELSE 'APPROVED' END")


def is_weekend(c: Column | str) -> Column:
    return F.dayofweek(as_col(c)).isin(1, 7)


def is_payday(c: Column | str, days: list[int] | None = None, include_last_day: bool = False) -> Column:
    c = as_col(c)
    flag = F.dayofmonth(c).isin(days or PAYDAYS)
    return flag | (F.last_day(c) == F.to_date(c)) if include_last_day else flag


def is_inflow(c: Column | str = "transaction_type") -> Column:
    return as_col(c).isin(INFLOW_TYPES)


def parse_amount(text: Column) -> Column:
    """Numeric text to double; NULL for anything that is not a finite plain number."""
    value = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def epoch_slot(c: Column | str, seconds: int) -> Column:
    """Number of the fixed-width time slot a timestamp falls in."""
    return F.floor(F.unix_micros(as_col(c)) / F.lit(seconds * 1_000_000)).cast("bigint")


def present(doc: Column, key: str) -> Column:
    """True when the key occurs, even with a null value."""
    return F.coalesce(F.map_contains_key(doc, key), F.lit(False))


def last_txn_key() -> Column:
    return F.concat(F.lit("customer:"), F.col("bank_entity"), F.lit(":"), F.col("customer_id"), F.lit(":last_txn"))


def cache_key() -> Column:
    return F.concat(F.lit("txn:"), F.col("transaction_id"))
