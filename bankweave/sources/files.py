"""Readers: typed files, lots of messages, market data, feeds, lake layers and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankweave import schemas as S
from bankweave.functions import days_before, hours_before, ts_lit
from bankweave.operators.validate import required_gaps


def read_history_flagged(spark: SparkSession, path: str) -> DataFrame:
    """Typed CSV history with ``gaps``, the required values a row lacks.

    The CSV reader turns unreadable values into NULL and ignores NOT NULL, hence the explicit check.
    """
    return spark.read.schema(S.HISTORY).option("header", True).csv(path).withColumn("gaps", required_gaps(S.HISTORY))


def read_history(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rows lacking a required value)."""
    df = read_history_flagged(spark, path)
    return df.filter(F.size("gaps") == 0).drop("gaps"), df.filter(F.size("gaps") > 0)


def lookback(df: DataFrame, as_of, days: int = 90, ts: str = "transaction_timestamp") -> DataFrame:
    """Rows of the last ``days`` days; on a stored table the date folders are pruned as well."""
    return since_days(df, as_of, days, ts)


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "text",
    glob: str | None = None, max_files: int | None = None,
) -> DataFrame:
    """Stream of messages from a folder.  Text messages arrive in a column named ``raw``."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.load(path)
    return df.withColumnRenamed("value", "raw") if fmt == "text" else df


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Broker form of ``read_stream``; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(**options).load().select(F.col("value").cast("string").alias("raw"))


def read_daily_close(spark: SparkSession, path: str) -> DataFrame:
    """Nested daily-close files, flattened; run and bank also come from the landing path."""
    where = F.col("_metadata.file_path")
    part = r"batch/(?:[a-z_]+=)?([^/]+)/(?:[a-z_]+=)?([^/]+)/"
    return (
        spark.read.schema(S.DAILY_CLOSE).option("recursiveFileLookup", True).json(path)
        .select(
            "bank_entity", "extraction_date", "execution_id", "records_type",
            F.col("accounts_summary.total_accounts").alias("total_accounts"),
            F.col("accounts_summary.active_accounts").alias("active_accounts"),
            F.col("accounts_summary.total_balance").alias("total_balance"),
            F.col("transactions_summary.total_count").alias("total_count"),
            F.col("transactions_summary.total_amount").alias("total_amount"),
            F.regexp_extract(where, part, 1).alias("path_execution"),
            F.regexp_extract(where, part, 2).alias("path_bank"),
        )
    )


def explode_lots(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per message of ``{"transactions": [...]}``; ``lot_error`` where the list is absent."""
    items = F.from_json(F.col(body), "transactions ARRAY<STRING>").getField("transactions")
    return (
        df.withColumn("_items", items)
        .withColumn("lot_error", F.when(F.col("_items").isNull(), F.lit(S.MSG_NO_LOT)))
        .select("*", F.posexplode_outer("_items").alias("position", "raw")).drop("_items")
        # An empty list yields no message and no error, only its lot's zero totals.
    )


def single_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """One message per request; an empty or null object is an error of its own."""
    keys = F.expr(f"json_object_keys({body})")
    empty = (F.size(keys) == 0) | (F.trim(F.col(body)) == "null")
    return df.withColumn("raw", F.col(body)).withColumn(
        "request_error", F.when(F.coalesce(empty, F.lit(False)), F.lit(S.MSG_EMPTY_BODY)))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def as_market(df: DataFrame, name: str) -> DataFrame:
    """Columns and types of a declared warehouse table."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in S.WAREHOUSE[name].fields])


def read_fx(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.EXCHANGE_RATES).parquet(path)


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.INTEREST_RATES).parquet(path)


def read_feed(spark: SparkSession, name: str, path: str | None = None, fmt: str | None = None, **options: str) -> DataFrame:
    """Any of the registered batch feeds, with the file each row came from.

    A database feed takes ``url``, ``dbtable`` and, so that it is read in parallel,
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``.
    """
    default, schema = S.FEEDS[name]
    fmt = fmt or default
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**options).load().select(*schema.fieldNames())
    if fmt == "csv":
        options.setdefault("header", "true")
    df = spark.read.format(fmt).schema(schema).options(**options).load(path)
    return df.select("*", F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.file_modification_time").alias("source_modified_at"), F.lit(name).alias("feed"))


LAYERS = ("bronze", "silver", "gold")


def layer_path(lake: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}")
    return f"{lake.rstrip('/')}/{layer}/{table}"


def read_layer(spark: SparkSession, lake: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(layer_path(lake, layer, table))


def replay(bronze: DataFrame, since, until=None, bank: str | None = None) -> DataFrame:
    """Messages that arrived in [since, until), by arrival partition, optionally of one bank."""
    df = bronze.filter(F.col("arrival_date") >= F.lit(str(since)).cast("date"))
    if until is not None:
        df = df.filter(F.col("arrival_date") < F.lit(str(until)).cast("date"))
    return df.filter(F.col("bank_entity") == bank) if bank else df


def by_bank(df: DataFrame, bank: str | None = None, column: str = "bank_entity") -> DataFrame:
    """Optional bank predicate."""
    return df.filter(F.col(column) == F.lit(bank)) if bank else df


def by_channel(df: DataFrame, channels: list[str] | None = None) -> DataFrame:
    return df.filter(F.col("channel").isin(*channels)) if channels else df


def _from(df: DataFrame, start: Column) -> DataFrame:
    """Also limit the date partition column of a stored table, so that older folders are not read."""
    return df.filter(F.col("tx_date") >= F.to_date(start)) if "tx_date" in df.columns else df


def on_day(df: DataFrame, day, ts: str = "transaction_timestamp") -> DataFrame:
    """Rows of one calendar day, as a range on the raw column so that it reaches the scan."""
    date = F.lit(str(day)).cast("date")
    if "tx_date" in df.columns:
        df = df.filter(F.col("tx_date") == date)
    start = date.cast("timestamp")
    return df.filter((F.col(ts) >= start) & (F.col(ts) < start + F.make_dt_interval(F.lit(1))))


def since_hours(df: DataFrame, as_of, hours: int, ts: str = "transaction_timestamp") -> DataFrame:
    start = hours_before(ts_lit(as_of), hours)
    return _from(df, start).filter(F.col(ts) >= start)


def since_days(df: DataFrame, as_of, days: int, ts: str = "transaction_timestamp") -> DataFrame:
    start = days_before(ts_lit(as_of), days)
    return _from(df, start).filter(F.col(ts) >= start)
