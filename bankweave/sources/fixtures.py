"""Views of the shared test tables in the shape of bank transactions and their companions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankweave.functions import decide, hash_score, money
from bankweave.operators.scale import spread
from bankweave.session import new_folder, path_exists
from bankweave.sources.generate import calendar_of

AS_OF = "2024-01-31 00:00:00"
TODAY = "2024-01-15"
LOOKBACK_DAYS = 14
HOLIDAYS = ["2024-01-01", "2024-01-08"]
BANKS = [f"bank-{i:02d}" for i in range(12)]
# The columns of a transaction.
TX_COLUMNS = [
    "transaction_id", "bank_entity", "customer_id", "transaction_type", "amount", "currency", "source_account",
    "destination_account", "destination_bank", "channel", "status", "fraud_score", "latitude", "longitude",
    "device_id", "transaction_timestamp", "processing_timestamp", "branch_id", "is_fraud",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index, options: list[str]):
    expr = F.when(index == 0, options[0])
    for i, option in enumerate(options[1:-1], start=1):
        expr = expr.when(index == i, option)
    return expr.otherwise(options[-1])


def from_events(ev: DataFrame) -> DataFrame:
    """All events as transactions; ``error`` events get a type that validation rejects."""
    k = "cast(get_json_object(props, '$.k') AS int)"
    app = "event_id % 4 = 0"
    df = ev.selectExpr(
        "'T' || event_id AS transaction_id",
        f"'bank-' || lpad({k} % 12, 2, '0') AS bank_entity",
        "'CLI-' || user_id AS customer_id",
        "CASE event_type WHEN 'click' THEN 'TRANSFER' WHEN 'view' THEN 'PAYMENT' WHEN 'purchase' THEN 'WITHDRAWAL' "
        "WHEN 'signup' THEN 'DEPOSIT' ELSE 'ERROR' END AS transaction_type",
        "value AS amount",
        "CASE event_id % 3 WHEN 0 THEN 'DLD' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency",
        "'BAN-' || user_id AS source_account",
        "'BAN-' || event_id AS destination_account",
        f"'bank-' || lpad(({k} + 5) % 12, 2, '0') AS destination_bank",
        "CASE event_id % 4 WHEN 0 THEN 'APP' WHEN 1 THEN 'ATM' WHEN 2 THEN 'BRANCH' ELSE 'CORRESPONDENT' END AS channel",
        "4.5D + cast(event_id % 6500 AS double) / 1000.0D AS latitude",
        "-75.0D + cast(event_id % 8000 AS double) / 1000.0D AS longitude",
        f"CASE WHEN {app} THEN 'DEV-' || user_id END AS device_id",
        "cast(ts AS timestamp) AS transaction_timestamp",
        "timestamp_micros(unix_micros(cast(ts AS timestamp)) + event_id % 500 * 1000) AS processing_timestamp",
        f"CASE WHEN {app} THEN NULL ELSE 'SUC-' || lpad(user_id % 50, 3, '0') END AS branch_id",
        f"CASE WHEN {app} AND value >= 60 THEN 1 ELSE 0 END AS is_fraud",
    )
    scored = df.withColumn("fraud_score", hash_score("transaction_id"))
    return scored.withColumn("status", decide("fraud_score")).select(*TX_COLUMNS)


def all_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(table(spark, sf_dir, "events"))


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid transactions."""
    return from_events(_valid(spark, sf_dir))


def tx_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid transactions, over as many tasks as their number asks for, whatever row groups the table has."""
    return from_events(spread(_valid(spark, sf_dir)))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("event_type") != "error")


def tx_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as transactions of several years, for reports that need long history."""
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey || '-' || l_linenumber AS transaction_id",
        "'bank-' || lpad(l_suppkey % 12, 2, '0') AS bank_entity",
        "'CLI-' || l_partkey AS customer_id",
        "CASE l_linenumber % 4 WHEN 0 THEN 'TRANSFER' WHEN 1 THEN 'PAYMENT' WHEN 2 THEN 'WITHDRAWAL' ELSE 'DEPOSIT' END AS transaction_type",
        "l_extendedprice AS amount",
        "CASE l_partkey % 4 WHEN 0 THEN 'APP' WHEN 1 THEN 'ATM' WHEN 2 THEN 'BRANCH' ELSE 'CORRESPONDENT' END AS channel",
        "cast(l_shipdate AS timestamp) AS transaction_timestamp",
        "CASE WHEN l_partkey % 4 <> 0 THEN 'SUC-' || lpad(l_suppkey % 50, 3, '0') END AS branch_id",
    )
    return df.withColumn("fraud_score", hash_score("transaction_id")).withColumn("status", decide("fraud_score"))


def fx_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange-rate ticks out of the ``error`` events."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    base = _pick(F.col("event_id") % 3, ["DLD", "USD", "EUR"])
    return ev.select(
        F.concat(F.lit("P"), F.col("event_id").cast("string")).alias("pair_id"), base.alias("base_currency"),
        F.lit("DLD").alias("quote_currency"), F.round(1 + F.col("value") / 1000, 5).alias("rate"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.lit("feed").alias("source"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer master data, keyed as transactions are."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.concat(F.lit("CLI-"), F.col("c_custkey").cast("string")).alias("customer_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), F.col("n_name").alias("country_code"),
    )


def bank_calendar(spark: SparkSession, sf_dir: str, extra_days: int = 30) -> DataFrame:
    """Days the events cover and the month after."""
    return calendar_of(table(spark, sf_dir, "events"), "ts", HOLIDAYS, extra_days)


def interest_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rates per nation, each taking over from the one before after ten days."""
    n = table(spark, sf_dir, "nation").withColumn("m", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    key = F.col("n_nationkey")
    return n.select(
        F.concat_ws("-", F.lit("R"), key.cast("string"), F.col("m").cast("string")).alias("rate_id"),
        F.col("n_name").alias("country_code"), _pick(key % 4, ["LENDING", "SAVINGS", "MORTGAGE", "INTERBANK"]).alias("rate_type"),
        (F.lit(0.02) + ((key * 7 + F.col("m")) % 50).cast("double") / 1000.0).alias("rate_value"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("m") * 10).alias("effective_date"), F.lit("central").alias("source"),
    )


def daily_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested daily closes of each bank; every seventh day's count is off by one on purpose."""
    day = tx(spark, sf_dir).groupBy("bank_entity", F.to_date("transaction_timestamp").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("amount")).cast("double").alias("amount"),
        F.count_distinct("customer_id").alias("customers"))
    off = F.when(F.dayofmonth("d") % 7 == 0, 1).otherwise(0)
    return day.select(
        "bank_entity", F.col("d").cast("timestamp").alias("extraction_date"),
        F.date_format("d", "yyyyMMdd_HHmmss").alias("execution_id"), F.lit("daily_close").alias("records_type"),
        F.struct(F.col("customers").alias("total_accounts"), F.col("customers").alias("active_accounts"),
                 F.col("amount").alias("total_balance")).alias("accounts_summary"),
        F.struct((F.col("n") + off).alias("total_count"), F.col("amount").alias("total_amount")).alias("transactions_summary"),
    )


# Message variants by event number modulo 40; the rest stay well formed.
VARIANTS = 40


def messages_of(rows: DataFrame) -> DataFrame:
    """Transactions as raw JSON text, with every kind of faulty message among them."""
    num = F.substr("transaction_id", F.lit(2)).cast("bigint")
    v = F.col("_v")
    stable = ["transaction_type", "source_account", "destination_account", "destination_bank", "status",
              "latitude", "longitude", "device_id", "branch_id", "is_fraud"]

    def member(key: str, value) -> Column:
        """``"key":value`` for a value that already is JSON text; NULL drops the member."""
        return F.concat(F.lit(f'"{key}":'), value)

    def quoted(c) -> Column:
        return F.concat(F.lit('"'), F.col(c) if isinstance(c, str) else c, F.lit('"'))

    def swap(value: Column, changes: dict) -> Column:
        for number, other in changes.items():
            value = F.when(v == number, other).otherwise(value)
        return value

    number = F.col("amount").cast("string")
    amount = swap(number, {
        1: F.lit(None), 3: F.lit("0"), 4: F.lit("-5"), 5: quoted(number), 6: F.lit('"abc"'), 7: F.lit("null"), 8: F.lit('"NaN"'),
        9: F.lit("true"), 18: F.lit('"1e3"'), 19: F.lit('"12.5f"'), 20: F.lit('{"x":1}'),
        22: F.lit("100000000000000000"), 23: F.lit("12.345678"), 30: F.lit("1e30")})
    bank = swap(quoted("bank_entity"), {2: F.lit('"bank-99"'), 10: F.concat(F.lit("["), quoted("bank_entity"), F.lit("]"))})
    time = quoted(F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    time = swap(time, {28: F.lit('"yesterday"'), 29: F.lit('"2099-01-01T00:00:00"')})
    members = [
        F.expr("substr(_stable, 2, length(_stable) - 2)"), member("customer_id", swap(quoted("customer_id"), {27: F.lit("null")})), member("bank_entity", bank), member("amount", amount),
        member("currency", F.when(~v.isin(0, 1), quoted("currency"))),
        member("channel", swap(quoted("channel"), {1: F.lit(None), 2: F.lit('"FAX"')})),
        member("transaction_id", swap(quoted("transaction_id"), {15: F.lit(None), 16: F.lit("null")})),
        member("transaction_timestamp", F.when(v != 17, time)),
        F.when(v == 21, member("teller", quoted("branch_id"))), F.when(v == 21, F.lit('"note":"x"')),
    ]
    whole = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    raw = swap(whole, {11: F.concat(F.lit("not json "), F.col("transaction_id")), 12: F.concat(F.lit("["), number, F.lit("]")),
                       13: F.lit(""), 14: F.lit("{}"), 24: F.concat(whole, F.lit("\n")), 25: F.concat(whole, F.lit("\r\n")), 26: F.concat(whole, F.lit("\t "))})
    return rows.withColumn("_v", num % VARIANTS).withColumn("_stable", F.to_json(F.struct(*stable))).select(
        num.alias("event_id"), F.to_date("transaction_timestamp").alias("arrival_date"), raw.alias("raw"))


_STAGED: dict[tuple[str, str], str] = {}


def message_folder(spark: SparkSession, sf_dir: str) -> str:
    """Raw messages as they arrive: files of text, written once per session from the events table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED or not path_exists(spark, _STAGED[key]):
        path = new_folder(spark, "messages")
        messages_of(all_tx(spark, sf_dir)).write.parquet(path)
        _STAGED[key] = path
    return _STAGED[key]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("event_id bigint, arrival_date date, raw string").parquet(message_folder(spark, sf_dir))


def tx_parts(spark: SparkSession, sf_dir: str, parts: int = 3) -> list[DataFrame]:
    """Valid transactions by time of the month, newest first; undated ones are with the oldest."""
    rows = tx_spread(spark, sf_dir)
    part = F.coalesce((F.dayofmonth("transaction_timestamp") * parts / 32).cast("int"), F.lit(0))
    return [rows.filter(part == n) for n in range(parts - 1, -1, -1)]


def lots(spark: SparkSession, sf_dir: str, size: int = 50) -> DataFrame:
    """All messages as ingest lots of at most ``size``; every third lot lacks its list.

    What is no JSON stands in its lot as a JSON text, so that a lot stays readable whatever is in it.
    """
    bodies = messages(spark, sf_dir).withColumn("lot_id", F.floor(F.col("event_id") / size).cast("bigint"))
    item = F.when(F.col("raw").rlike(r"^[\[{]"), F.col("raw")).otherwise(F.concat(F.lit('"'), F.col("raw"), F.lit('"')))
    grouped = bodies.groupBy("lot_id").agg(F.concat_ws(",", F.array_sort(F.collect_list(item))).alias("items"))
    key = F.when(F.col("lot_id") % 3 == 2, "records").otherwise("transactions")
    return grouped.select("lot_id", F.concat(F.lit('{"'), key, F.lit('":['), "items", F.lit("]}")).alias("body"))
