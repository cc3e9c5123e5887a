"""Streaming jobs.  Transformations are the batch functions; only state, sinks and progress live here."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from datetime import datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from bankweave.functions import cache_key, epoch_slot, last_txn_key, money, ts_lit
from bankweave.operators import aggregates, predict, validate, windows
from bankweave.operators.tables import INDEX_FROM, append_new, check_existing, write_transactions
from bankweave.session import adaptive, delete_path, new_folder, partition_values, write_text

TS = "transaction_timestamp"
# Writing order of the sinks: the profile serves the next score, the cache the callers,
# the warehouse the analysts, and the other banks are told last.
SINKS = ("profile", "cache", "warehouse", "distribution")
PROFILE_COLUMNS = ["bank_entity", "customer_id", TS, "transaction_id", "amount", "transaction_type", "channel", "fraud_score", "status"]


# Stateless part.

def score_stream(raw: DataFrame, banks: list[str] | None = None) -> DataFrame:
    """Raw messages to scored transactions, stamped with the current time."""
    return validate.clean_and_score(raw, F.current_timestamp(), banks)


def split_stream(raw: DataFrame, banks: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(scored, quarantined): a message that is invalid or cannot be stored never stops the query and is never lost."""
    now = F.current_timestamp()
    rows = validate.storable(raw, now, banks)
    bad = validate.quarantine(rows.withColumn("raw", F.col("_raw")), now)
    return rows.filter(F.size("errors") == 0).drop("errors", "_raw", "raw"), bad


def model_stream(stream: DataFrame, model: PipelineModel) -> DataFrame:
    return predict.model_scores(model, stream)


# Stateful part.  ``delay`` is how late an event may come into a windowed result; later ones are counted by Spark
# (numRowsDroppedByWatermark) and are in the warehouse all the same, from where the batch twin counts them.

def dedup(stream: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per id, whenever its copies come.

    There is no watermark: event times come from callers, and one clock that runs ahead would make every later
    message too late.  The ids seen are the price; they live in the state store on disk, spread over the shuffle partitions.
    """
    return stream.dropDuplicates([key])


def dedup_within(stream: DataFrame, horizon: str = "1 day", arrived: str = "arrived_at", key: str = "transaction_id") -> DataFrame:
    """One row per id within ``horizon`` of its first arrival; the state forgets ids after that.

    The watermark is on the time of arrival, which our own clock gives, so no row is ever late.  Copies that come
    later are met by the table they go to (``start_settled``).
    """
    return stream.withWatermark(arrived, horizon).dropDuplicatesWithinWatermark([key])


def tumbling_kpis(stream: DataFrame, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    return aggregates.kpi_counts(stream.withWatermark(TS, delay), width)


def sliding_velocity(stream: DataFrame, width: str = "1 hour", step: str = "15 minutes", delay: str = "10 minutes") -> DataFrame:
    return windows.sliding_counts(stream.withWatermark(TS, delay), width, step)


def customer_sessions(stream: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Sessions, emitted once closed."""
    return stream.withWatermark(TS, delay).groupBy(F.session_window(TS, gap).alias("w"), "customer_id").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum(money("amount")).cast("double").alias("amount"),
    ).select("customer_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "transactions", "amount")


def last_values(stream: DataFrame) -> DataFrame:
    """Latest cells per bank and customer, by event time; replaying events changes nothing."""
    cells = F.struct(*[c for c in PROFILE_COLUMNS if c not in ("bank_entity", "customer_id")])
    return stream.groupBy("bank_entity", "customer_id").agg(
        F.max_by(cells, F.struct(TS, "transaction_id")).alias("v")).select("bank_entity", "customer_id", "v.*")


def follow_up_stream(stream: DataFrame, reach: int = 3600, delay: str = "10 minutes") -> DataFrame:
    """Transactions that follow, within ``reach`` seconds, a block of the same customer at another bank.

    Both sides also match on a time slot as wide as the reach, a block being offered to its own
    slot and the next, so that the state of a busy customer is spread over slots.
    """
    left = stream.withColumn("_slot", epoch_slot(TS, reach)).withWatermark(TS, delay)
    own = epoch_slot(TS, reach)
    blocked = stream.filter(F.col("status") == "BLOCKED").select(
        F.col("customer_id").alias("b_customer"), F.col("bank_entity").alias("b_bank"), F.col(TS).alias("b_ts"),
        F.explode(F.array(own, own + 1)).alias("b_slot"),
    ).withWatermark("b_ts", delay)
    on = (F.col("customer_id") == F.col("b_customer")) & (F.col("_slot") == F.col("b_slot")) & (
        F.col("bank_entity") != F.col("b_bank")) & (F.col("b_ts") <= F.col(TS)) & (
        F.col(TS) <= F.col("b_ts") + F.expr(f"INTERVAL {int(reach)} SECONDS"))
    return left.join(blocked, on, "left_semi").drop("_slot")


# Sinks.

def start(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", by: Iterable[str] = (), name: str | None = None,
          available_now: bool = True) -> StreamingQuery:
    """Append a stream to a Parquet folder (exactly once: the file sink keeps its own commit log)."""
    writer = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(*by) if by else writer
    writer = writer.queryName(name) if name else writer
    return _go(writer, available_now, path)


def start_existing(stream: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Append to a table that must exist with the same schema; never creates it."""
    check_existing(stream.sparkSession, stream, path)
    return start(stream, path, checkpoint, **kw)


def _go(writer: DataStreamWriter, available_now: bool, path: str | None = None) -> StreamingQuery:
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(path) if path else writer.start()


def wait(query: StreamingQuery) -> StreamingQuery:
    """Wait until a bounded run has read all its input, however long that takes."""
    query.awaitTermination()
    return query


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Drain a stream into a folder of the shared space and return the written table."""
    spark = stream.sparkSession
    root = new_folder(spark, name)
    if mode == "append":
        wait(start(stream, f"{root}/out", f"{root}/checkpoint"))
        return spark.read.schema(stream.schema).parquet(f"{root}/out")
    wait(start_batches(stream, f"{root}/out", f"{root}/checkpoint", mode))
    return spark.read.parquet(f"{root}/out")


def _write_batch(df: DataFrame, folder: str, batch_id: int, by: Iterable[str] = ()) -> None:
    """Write a micro-batch to folders of its own, below those of ``by``; a retried batch replaces what it wrote before."""
    writer = df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by, "batch_id").parquet(folder)


def start_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "update", available_now: bool = True) -> StreamingQuery:
    """Write every micro-batch of an updating aggregate; ``newest`` reads the current values back."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return _go(writer.foreachBatch(lambda df, n: _write_batch(df, path, n)), available_now)


ACCOUNT = "account"


def accounted(stream: DataFrame) -> DataFrame:
    """The stream, counted as it enters: ``store_account`` finds the count in the query's progress."""
    return stream.observe(ACCOUNT, F.count(F.lit(1)).alias("rows_in"))


def store_account(spark: SparkSession, query: StreamingQuery, folder: str) -> None:
    """Keep what the query's progress says of its recent micro-batches; a batch told twice is kept once.

    A stream that never ends is asked now and then: Spark remembers the last 100 batches (spark.sql.streaming.numRecentProgressUpdates).
    """
    for p in query.recentProgress:
        seen = (p.observedMetrics or {}).get(ACCOUNT)
        rows = {"batch_id": p.batchId, "rows_in": int(seen["rows_in"]) if seen else 0, "watermark": (p.eventTime or {}).get("watermark"),
                "dropped_groups": sum(o.numRowsDroppedByWatermark for o in p.stateOperators)}
        if rows["rows_in"] or rows["dropped_groups"]:
            write_text(spark, f"{folder}/batch-{p.batchId}.json", json.dumps(rows))


def account(spark: SparkSession, folder: str) -> DataFrame:
    """Stored account: rows in, watermark and dropped groups of state (a group may stand for several rows) by micro-batch."""
    return spark.read.schema("batch_id bigint, rows_in bigint, watermark string, dropped_groups bigint").json(folder)


def newest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Current value per key out of the updates of all micro-batches."""
    values = [c for c in updates.columns if c not in keys and c != "batch_id"]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v")).select(*keys, "v.*")


def _cache_entries(df: DataFrame) -> DataFrame:
    return df.select(cache_key().alias("cache_key"), last_txn_key().alias("customer_key"), "transaction_id", "status",
                     "processing_timestamp", F.to_json(F.struct(*df.columns)).alias("value"))


def _hour(ts) -> Column:
    return F.date_format(ts, "yyyy-MM-dd-HH")


def _write_cache(df: DataFrame, folder: str, batch_id: int) -> None:
    """One folder for a micro-batch, below the hour of its newest entry, by which it expires as a whole; entries are in order of time."""
    spark = df.sparkSession
    upto = df.agg(_hour(F.max("processing_timestamp"))).first()[0] or "0000"  # one value
    for other in partition_values(spark, folder, "cache_upto"):
        if other != upto:  # of a batch that is repeated at a later hour
            delete_path(spark, f"{folder}/cache_upto={other}/batch_id={batch_id}")
    _cache_entries(df).sortWithinPartitions("processing_timestamp").write.mode("overwrite").parquet(f"{folder}/cache_upto={upto}/batch_id={batch_id}")


def _messages(statuses: tuple[str, ...] | None) -> Callable[[DataFrame], DataFrame]:
    return lambda df: validate.distribution(validate.for_statuses(df, statuses))


def start_multi_sink(stream: DataFrame, root: str, sinks: Iterable[str] = SINKS, statuses: tuple[str, ...] | None = None,
                     available_now: bool = True, compact_every: int = 100) -> StreamingQuery:
    """Write each micro-batch to the chosen sinks in order.

    Every sink writes folders named after the batch, so a batch repeated after a failure overwrites its own
    output and nothing is written twice.  The warehouse has the layout of every other transaction table, with the
    batch as its load.  ``statuses`` limits what the other banks are sent; the default sends every status.  Profile
    updates are folded into a snapshot every ``compact_every`` batches.
    """
    chosen = set(sinks)
    unknown = chosen - set(SINKS)
    if unknown:
        raise ValueError(f"unknown sinks {sorted(unknown)}")

    def write(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            if "profile" in chosen:
                _write_batch(last_values(df), f"{root}/profile/updates", batch_id)
                if batch_id % compact_every == compact_every - 1:
                    compact_profiles(df.sparkSession, root, batch_id)
            if "cache" in chosen:
                _write_cache(df, f"{root}/cache", batch_id)
            if "warehouse" in chosen:
                with adaptive(df.sparkSession):
                    write_transactions(df, f"{root}/warehouse", "overwrite", f"stream-{batch_id}")
            if "distribution" in chosen:
                _write_batch(_messages(statuses)(df), f"{root}/distribution", batch_id, ["bank_entity"])
        finally:
            df.unpersist()

    writer = stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(write)
    return _go(writer, available_now)


def start_settled(stream: DataFrame, path: str, checkpoint: str, horizon: str = "1 day", index_from: int = INDEX_FROM, available_now: bool = True) -> StreamingQuery:
    """Append each id once to a transaction table, with state for the ids of ``horizon`` alone: older ones are settled by the table's
    membership index, of which only the files that may hold one are read.  A repeated batch finds its own rows and adds nothing."""
    once = dedup_within(stream.withColumn("arrived_at", F.current_timestamp()), horizon).drop("arrived_at")

    def write(df: DataFrame, batch_id: int) -> None:
        with adaptive(df.sparkSession):
            append_new(df, path, load=f"stream-{batch_id}", index_from=index_from)

    return _go(once.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), available_now)


def _snapshot(spark: SparkSession, root: str) -> int:
    """Last batch that is folded into the profile snapshot, or -1."""
    return max((int(n) for n in partition_values(spark, f"{root}/profile/snapshot", "upto")), default=-1)


def current_profiles(spark: SparkSession, root: str) -> DataFrame:
    """Latest cells per bank and customer: the snapshot, and the updates of the batches after it."""
    upto = _snapshot(spark, root)
    cells = spark.read.parquet(f"{root}/profile/updates").filter(F.col("batch_id") > upto).drop("batch_id")
    if upto >= 0:
        cells = cells.unionByName(spark.read.parquet(f"{root}/profile/snapshot/upto={upto}"))
    return last_values(cells)


def compact_profiles(spark: SparkSession, root: str, upto: int | None = None) -> None:
    """Fold the updates into a new snapshot, then drop what it replaces."""
    done = [int(n) for n in partition_values(spark, f"{root}/profile/updates", "batch_id")]
    upto = max(done, default=-1) if upto is None else upto
    before = _snapshot(spark, root)
    if upto <= before:
        return
    current_profiles(spark, root).write.mode("overwrite").parquet(f"{root}/profile/snapshot/upto={upto}")
    # The newest batch may be repeated; its folder stays and is skipped by number.
    for n in done:
        if n < upto:
            delete_path(spark, f"{root}/profile/updates/batch_id={n}")
    if before >= 0:
        delete_path(spark, f"{root}/profile/snapshot/upto={before}")


def live_cache(spark: SparkSession, root: str, as_of, ttl: int = 3600) -> DataFrame:
    """Cache entries alive at ``as_of``: batches whose newest entry has expired are not read, and of the others only the row groups of that time."""
    now = ts_lit(as_of)
    since = now - F.make_dt_interval(secs=F.lit(ttl).cast("decimal(18,6)"))
    held = spark.read.parquet(f"{root}/cache").filter(F.col("cache_upto").cast("string") >= _hour(since))
    return held.filter((F.col("processing_timestamp") > since) & (F.col("processing_timestamp") <= now)).drop("cache_upto", "batch_id")


def purge_cache(spark: SparkSession, root: str, as_of, ttl: int = 3600) -> list[str]:
    """Delete the batches whose entries have all expired.  Returns the hours of their newest entries."""
    edge = (datetime.fromisoformat(str(as_of)) - timedelta(seconds=ttl)).strftime("%Y-%m-%d-%H")
    old = [h for h in partition_values(spark, f"{root}/cache", "cache_upto") if h < edge]
    for hour in old:
        delete_path(spark, f"{root}/cache/cache_upto={hour}")
    return old


def start_subscriber(spark: SparkSession, root: str, bank: str, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """One bank's own reader of its distribution folders, with its own progress.

    A batch that was repeated after a failure comes in new files; its messages are told by their ids and delivered once.
    """
    schema = "transaction_id string, message string"
    source = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/distribution/bank_entity={bank}")
    return start(dedup(source).withColumn("bank_entity", F.lit(bank)), out, checkpoint, available_now=available_now)
