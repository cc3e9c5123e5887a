"""Cache entries with a time to live, kept as streaming state in RocksDB.

An entry is put when its transaction comes and leaves the state by itself when its time is over; every change is emitted.
The watermark lags by exactly the time to live: what Spark drops as late has expired already, and a timer, set
to its bucket's oldest entry, fires as soon as the newest event is a time to live ahead of it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from bankweave.functions import cache_key, last_txn_key
from bankweave.session import ROCKSDB, STATE_STORE, setting
from bankweave.streaming.flows import start_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package installed

TTL = 3600
AT = "processing_timestamp"
# Fixed value: entries lie in the state by bucket, so a stored state keeps it.
BUCKETS = 4096
_FIELDS = ["cache_key", "customer_key", "transaction_id", "status", "at", "value"]
_ENTRY = "cache_key string, customer_key string, transaction_id string, status string, at bigint, value string"
_AT = _FIELDS.index("at")


class Entries(StatefulProcessor):
    """The newest entry of every key of a bucket, and one timer, set to the oldest of them.

    A call of the state costs about as much for one entry as for hundreds, so keys share buckets; entries without a
    forerunner are appended, and a bucket is written anew only when a key is renewed or its time is over.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getListState("entry", _ENTRY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f[_FIELDS] for f in rows if len(f)]
        if not frames:
            return
        new = pd.concat(frames).sort_values("at", ascending=False, kind="stable").drop_duplicates("cache_key")
        before = {e[0]: e for e in self.entries.get()}
        put = [e for e in new.itertuples(index=False, name=None) if e[0] not in before or e[_AT] > before[e[0]][_AT]]
        if not put:
            return
        renewed = {e[0] for e in put if e[0] in before}
        if renewed:
            self.entries.put([e for k, e in before.items() if k not in renewed] + put)
        else:
            self.entries.appendList(put)
        self._wake(min(e[_AT] for e in put))
        yield self._changes("put", put)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        over, left = [], []
        for e in self.entries.get():
            (over if e[_AT] // 1000 <= now else left).append(e)
        if left:
            if over:
                self.entries.put(left)
            self.handle.registerTimer(min(e[_AT] for e in left) // 1000)
        else:
            self.entries.clear()
        if over:
            yield self._changes("evict", over)

    def _wake(self, at: int) -> None:
        """Let the bucket's timer fire no later than at ``at``."""
        timers = list(self.handle.listTimers())
        if timers and min(timers) <= at // 1000:
            return
        for timer in timers:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at // 1000)

    @staticmethod
    def _changes(change: str, entries: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(entries, columns=_FIELDS).assign(change=change)


def cache_changes(stream: DataFrame, ttl: int = TTL) -> DataFrame:
    """What happens to the cache: an entry is put, or evicted once it is ``ttl`` seconds old.

    A key that comes again is renewed if it is newer; older or expired entries change nothing.  Rows without id or time have no
    entry.
    """
    entries = stream.filter(F.col("transaction_id").isNotNull() & F.col(AT).isNotNull()).select(
        cache_key().alias("cache_key"), last_txn_key().alias("customer_key"), "transaction_id", "status", AT, F.unix_micros(AT).alias("at"), F.to_json(F.struct(*stream.columns)).alias("value"))
    entries = entries.withColumn("bucket", F.pmod(F.xxhash64("cache_key"), F.lit(BUCKETS)))
    changes = entries.withWatermark(AT, f"{ttl} seconds").groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=Entries(), outputStructType=f"{_ENTRY}, change string", outputMode="Update", timeMode="EventTime")
    return changes.select("cache_key", "change", "customer_key", "transaction_id", "status", F.timestamp_micros("at").alias(AT), "value")


def start_cache(stream: DataFrame, root: str, ttl: int = TTL, available_now: bool = True) -> StreamingQuery:
    """Keep the cache and write its changes, a folder for each micro-batch.  A repeated batch replaces what it wrote; a restart finds the state.

    An entry and its timer need a state store with several column families, which Spark's default one is not; a query keeps the store it
    is started with, so the session's own setting stays.
    """
    with setting(stream.sparkSession, STATE_STORE, ROCKSDB):
        return start_batches(cache_changes(stream, ttl), f"{root}/changes", f"{root}/checkpoint", available_now=available_now)


def alive(spark: SparkSession, root: str) -> DataFrame:
    """Entries that were put and not evicted since."""
    changes = spark.read.parquet(f"{root}/changes")
    last = changes.groupBy("cache_key").agg(F.max_by(F.struct(*[c for c in changes.columns if c not in ("cache_key", "batch_id")]), F.struct("batch_id", AT, F.col("change") == "evict")).alias("v"))
    return last.select("cache_key", "v.*").filter(F.col("change") == "put").drop("change")


def held(spark: SparkSession, root: str) -> DataFrame:
    """The entries that are in the state store itself, as of the last committed batch."""
    rows = spark.read.format("statestore").option("stateVarName", "entry").load(f"{root}/checkpoint")
    return rows.select("list_element.*").withColumn("at", F.timestamp_micros("at"))
