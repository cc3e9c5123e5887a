"""Message checks, accept/reject split, defaults and scoring.

Every function maps a DataFrame to a DataFrame and holds no state, so it serves batch
and streaming alike.  A message is parsed once, into a map of its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankweave import schemas as S
from bankweave.functions import decide, hash_score, parse_amount, present, ts_lit

JSON_SPACE = " \t\r\n"
_JSON_OPTIONS = {"allowNonNumericNumbers": "false"}
_TEXT_FIELDS = [
    "transaction_id", "bank_entity", "customer_id", "transaction_type", "currency", "source_account",
    "destination_account", "destination_bank", "channel", "status", "device_id", "branch_id",
]
_NUMBER_FIELDS = ["latitude", "longitude"]
_KNOWN = [*_TEXT_FIELDS, *_NUMBER_FIELDS, "amount", "fraud_score", "transaction_timestamp", "is_fraud", "processing_timestamp"]


def parse(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``doc`` (key to text map) and ``malformed`` (not one JSON object).

    ``doc`` comes out of a one-element explode because later filters do not move below it:
    as a plain column it would be parsed again in every filter the planner pushes down.
    """
    text = F.col(raw).cast("string")
    doc = F.when(F.rtrim(text, F.lit(JSON_SPACE)).endswith("}"), F.from_json(text, T.MapType(T.StringType(), T.StringType()), _JSON_OPTIONS))
    return df.select("*", F.explode(F.array(doc)).alias("doc")).withColumn("malformed", F.col("doc").isNull())


def drop_nulls(errors: list[Column]) -> Column:
    """Array of the errors that occurred.

    The lambda form keeps the check out of the generated loop around it.  Fused into one loop,
    parse, checks and typing outgrow what the JVM compiles, and run several times slower.
    """
    return F.filter(F.array(*errors), lambda e: e.isNotNull())


def missing_errors(doc: Column) -> list[Column]:
    return [F.when(~present(doc, f), F.lit(S.MSG_MISSING + f)) for f in S.REQUIRED_FIELDS]


def value_errors(doc: Column, banks: list[str]) -> list[Column]:
    def outside(key: str, catalog: list[str], message: str) -> Column:
        value = F.coalesce(doc[key], F.lit("None"))
        return F.when(~value.isin(catalog), F.concat(F.lit(message), value))

    amount = parse_amount(doc["amount"])
    return [
        outside("bank_entity", banks, S.MSG_BANK),
        outside("transaction_type", S.TRANSACTION_TYPES, S.MSG_TYPE),
        outside("channel", S.CHANNELS, S.MSG_CHANNEL),
        F.when(amount.isNull(), F.lit(S.MSG_AMOUNT)).when(amount <= 0, F.lit(S.MSG_NOT_POSITIVE)),
    ]


def validate(df: DataFrame, banks: list[str] | None = None, raw: str = "raw") -> DataFrame:
    """Add ``errors``: absent fields, or, when none is absent, every bad value."""
    df = df if "doc" in df.columns else parse(df, raw)
    doc = F.col("doc")
    has_all = F.lit(True)
    for field in S.REQUIRED_FIELDS:
        has_all = has_all & present(doc, field)
    checks = F.when(has_all, drop_nulls(value_errors(doc, banks or S.BANKS))).otherwise(drop_nulls(missing_errors(doc)))
    errors = F.when(F.col("malformed"), F.array(F.lit("malformed"))).otherwise(checks)
    return df.withColumn("errors", errors)


def verdict(df: DataFrame) -> DataFrame:
    """Per-row answer: id (or ``unknown`` on rejection), status and errors."""
    ok = F.size("errors") == 0
    given = F.col("doc")["transaction_id"]
    fallback = F.when(ok, F.sha2("raw", 256)).otherwise("unknown")
    return df.withColumn("reply_id", F.coalesce(given, fallback)).withColumn(
        "verdict", F.when(ok, "ACCEPTED").otherwise("REJECTED"))


def lot_totals(df: DataFrame, keys: list[str]) -> DataFrame:
    """``total``, ``accepted`` and ``rejected`` per lot."""
    accepted = F.count_if(F.size("errors") == 0)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), accepted.alias("accepted"), (F.count(F.lit(1)) - accepted).alias("rejected"))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.size("errors") == 0)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.size("errors") > 0)


def default_id(raw: str = "raw") -> Column:
    """Given id, else a digest of the message, so that a replay defaults to the same id."""
    return F.coalesce(F.col("doc")["transaction_id"], F.sha2(F.col(raw).cast("string"), 256))


def event_time(processing: Column) -> Column:
    """Event time of the message; the processing time where the key is absent."""
    given = F.col("doc")["transaction_timestamp"]
    return F.when(present(F.col("doc"), "transaction_timestamp"), F.try_to_timestamp(given)).otherwise(processing)


def typed(df: DataFrame, now: Column, raw: str = "raw") -> DataFrame:
    """Typed transaction columns of parsed messages; unknown keys go to ``metadata``."""
    doc = F.col("doc")
    extras = F.map_filter(doc, lambda k, v: ~k.isin(_KNOWN))
    return df.select(
        *[c for c in df.columns if c not in {"doc", "malformed", "errors", *_KNOWN, "metadata"}],
        default_id(raw).alias("transaction_id"),
        *[doc[f].alias(f) for f in _TEXT_FIELDS if f != "transaction_id"],
        parse_amount(doc["amount"]).alias("amount"),
        *[doc[f].try_cast("double").alias(f) for f in _NUMBER_FIELDS],
        doc["is_fraud"].try_cast("int").alias("is_fraud"),
        event_time(now).alias("transaction_timestamp"),
        now.alias("processing_timestamp"),
        F.when(F.size(extras) > 0, F.to_json(extras)).alias("metadata"),
    )


def admit(df: DataFrame, now: Column, raw: str = "raw") -> DataFrame:
    """Ingest step for accepted messages: default id, ingestion time, status PENDING."""
    return (
        typed(df, now, raw).drop("processing_timestamp")
        .withColumn("ingestion_timestamp", now).withColumn("status", F.lit("PENDING"))
    )


def score(df: DataFrame) -> DataFrame:
    """Hash score and the status it leads to."""
    return df.withColumn("fraud_score", hash_score("transaction_id")).withColumn("status", decide("fraud_score"))


def clean_and_score(df: DataFrame, now: Column, banks: list[str] | None = None, raw: str = "raw") -> DataFrame:
    """Raw messages to scored transactions: parse, check, default, score.  Stateless."""
    return score(typed(accepted(validate(df, banks, raw)), now, raw))


def warehouse_gaps() -> Column:
    """Names of required warehouse columns a row cannot fill (null, or more than the declared numeric type holds)."""
    required = [f.name for f in S.TRANSACTIONS.fields if not f.nullable]
    checks = [F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in required]
    checks.append(F.when(F.col("amount").isNotNull() & F.col("amount").try_cast(S.AMOUNT).isNull(), F.lit("amount out of range")))
    return drop_nulls(checks)


def storable(df: DataFrame, now: Column, banks: list[str] | None = None, raw: str = "raw") -> DataFrame:
    """Every message with its scored columns and ``errors``: what validation found or, where it found nothing, what
    the warehouse cannot hold.  A row without errors can be stored everywhere, any other belongs in quarantine."""
    checked = validate(df, banks, raw)
    rows = score(typed(checked.withColumn("_found", F.col("errors")).withColumn("_raw", F.col(raw).cast("string")), now, raw))
    gaps = F.when(F.size("_found") == 0, warehouse_gaps()).otherwise(F.col("_found"))
    return rows.withColumn("errors", gaps).drop("_found")


def required_gaps(schema: T.StructType) -> Column:
    """Same check for any schema: readers make columns nullable, so it has to be explicit."""
    checks = [F.when(F.col(f.name).isNull(), F.lit(f"null {f.name}")) for f in schema.fields if not f.nullable]
    return drop_nulls(checks)


def distribution(df: DataFrame) -> DataFrame:
    """Eight-field payload for the other banks, without position or device, routed by bank."""
    body = F.to_json(
        F.struct("transaction_id", "bank_entity", "customer_id", "status", "amount", "currency",
                 "fraud_score", "processing_timestamp"),
        {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return df.select("bank_entity", "transaction_id", body.alias("message"))


def for_statuses(df: DataFrame, statuses: tuple[str, ...] | None = None) -> DataFrame:
    return df if statuses is None else df.filter(F.col("status").isin(*statuses))


# Delivery attempts and back-off bounds of a failed message.
MAX_ATTEMPTS = 5
BACKOFF_MIN_S = 10
BACKOFF_MAX_S = 600


def quarantine(df: DataFrame, now: Column, raw: str = "raw") -> DataFrame:
    """Rejected messages with what is needed to try them again."""
    return rejected(df).select(
        F.col(raw).cast("string").alias("raw"), "errors", F.lit(1).alias("attempt"), now.alias("failed_at"))


def with_backoff(dead: DataFrame) -> DataFrame:
    """The first failure waits the least, and each later one twice as long, up to the most."""
    wait = F.least(F.lit(BACKOFF_MIN_S) * F.pow(F.lit(2.0), F.col("attempt") - 1), F.lit(float(BACKOFF_MAX_S)))
    return dead.withColumn(
        "next_attempt_at", F.timestamp_seconds(F.unix_micros("failed_at") / F.lit(1e6) + wait)
    ).withColumn("parked", F.col("attempt") >= MAX_ATTEMPTS)


def due(dead: DataFrame, as_of) -> DataFrame:
    """Quarantined messages whose wait is over and whose attempts are not used up."""
    return with_backoff(dead).filter(~F.col("parked") & (F.col("next_attempt_at") <= ts_lit(as_of)))


def readmit(dead: DataFrame, as_of, banks: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Try due messages again: (now accepted, still failing with one more attempt)."""
    again = validate(parse(due(dead, as_of).select("raw", "attempt")), banks)
    failed = rejected(again).select("raw", "errors", (F.col("attempt") + 1).alias("attempt"), ts_lit(as_of).alias("failed_at"))
    return accepted(again), failed
