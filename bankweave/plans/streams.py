"""Registered queries: bounded runs of the streaming jobs, read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankweave.operators import aggregates as A
from bankweave.operators import joins as J
from bankweave.operators import tables as K
from bankweave.plans import jobs
from bankweave.plans.registry import query, sql
from bankweave.plans.reports import FOLLOW_UPS, LATEST, SESSIONS, SLIDING
from bankweave.session import new_folder, stage
from bankweave.sources import files
from bankweave.sources import fixtures as fx
from bankweave.streaming import flows

TYPED = ["event_id", "bank_entity", "customer_id", "transaction_type", "amount", "channel", "fraud_score", "status"]


def event_stream(spark, sf) -> DataFrame:
    schema = fx.table(spark, sf, "events").schema
    return files.read_stream(spark, sf, schema, "parquet", glob="events.parquet")


def tx_stream(spark, sf) -> DataFrame:
    return fx.from_events(event_stream(spark, sf).filter(F.col("event_type") != "error"))


def message_stream(spark, sf) -> DataFrame:
    """Staged messages as a stream."""
    return files.read_stream(spark, fx.message_folder(spark, sf), fx.messages(spark, sf).schema, "parquet")


def arrivals(spark, folder: str, parts: list[DataFrame], start) -> None:
    """Parts arrive one after the other, each as the files its tasks write; after each the queries go on from where they stopped."""
    for part in parts:
        part.write.mode("append").parquet(folder)
        started = start(files.read_stream(spark, folder, part.schema, "parquet"))
        for q in started if isinstance(started, list) else [started]:
            flows.wait(q)


def late_arrivals(spark, sf, root: str, start) -> None:
    """Valid transactions in several parts, newest first, so that a stream of them meets its late rows last."""
    arrivals(spark, f"{root}/arrivals", fx.tx_parts(spark, sf), start)


@query("s3_stream_scan", sql("fate", """
    SELECT event_id, NULL AS errors, 1 AS n FROM fate WHERE faults = '' OR faults IS NULL
    UNION ALL SELECT NULL, faults, count(*) FROM fate WHERE faults <> '' GROUP BY ALL"""))
def s3(spark, sf):
    """Nothing is lost: every message is scored, or stands in quarantine with its reason."""
    good, bad = flows.split_stream(message_stream(spark, sf), fx.BANKS)
    ok = flows.run_to_table(good.select("event_id"), "scan-good").select("event_id", F.lit(None).cast("string").alias("errors"), F.lit(1).cast("long").alias("n"))
    stored = flows.run_to_table(bad, "scan-bad").groupBy(F.array_join("errors", "; ").alias("errors")).agg(F.count(F.lit(1)).alias("n"))
    return ok.unionByName(stored.select(F.lit(None).cast("long").alias("event_id"), "errors", "n"))


@query("r2_every_message_kept", sql("fate", """
    SELECT 'stored' AS place, bank_entity AS k, count(*) AS n FROM fate WHERE faults = '' OR faults IS NULL GROUP BY ALL
    UNION ALL SELECT 'quarantine', faults, count(*) + count(*) FILTER (event_id % 10 = 0) FROM fate WHERE faults <> '' GROUP BY ALL"""))
def r2_kept(spark, sf):
    """Messages in several parts, newest first, one dated years ahead among them, and a last part that repeats some."""
    root, raw = new_folder(spark, "kept"), fx.messages(spark, sf)
    newest = F.coalesce(F.col("arrival_date") >= "2024-01-16", F.lit(False))
    parts = [raw.filter(part).select("raw") for part in (newest, ~newest, F.col("event_id") % 10 == 0)]
    arrivals(spark, f"{root}/in", parts, lambda stream: list(jobs.start_message_queries(stream, f"{root}/out", ("warehouse",), fx.BANKS)))
    stored = spark.read.parquet(f"{root}/out/warehouse").groupBy(F.lit("stored").alias("place"), F.col("bank_entity").alias("k"))
    faulty = spark.read.parquet(f"{root}/out/quarantine").groupBy(F.lit("quarantine").alias("place"), F.array_join("errors", "; ").alias("k"))
    return stored.agg(F.count(F.lit(1)).alias("n")).unionByName(faulty.agg(F.count(F.lit(1)).alias("n")))


@query("r1_score_stream", sql("msg", """
    SELECT event_id, bank_entity, customer_id, transaction_type, parsed_amount AS amount, channel, v IN (15, 16) AS id_defaulted,
      CASE WHEN v NOT IN (15, 16) THEN fraud_score END AS fraud_score, CASE WHEN v NOT IN (15, 16) THEN status END AS status
    FROM msg WHERE len(errors) = 0"""))
def r1(spark, sf):
    scored = flows.score_stream(message_stream(spark, sf), fx.BANKS)
    out = flows.run_to_table(scored.select(*TYPED, "transaction_id"), "scored")
    # A digest id, and so its score, depends on the text of the message, which the check does not rebuild.
    given = F.length("transaction_id") < 64
    return out.withColumn("id_defaulted", ~given).withColumn("fraud_score", F.when(given, F.col("fraud_score"))).withColumn(
        "status", F.when(given, F.col("status"))).select(*TYPED, "id_defaulted")


@query("r2_multi_sink", sql("tx", """
    SELECT 'profile' AS sink, count(DISTINCT bank_entity || customer_id) AS n FROM tx UNION ALL SELECT 'cache', count(*) FROM tx
    UNION ALL SELECT 'warehouse', count(*) FROM tx UNION ALL SELECT 'distribution', count(*) FROM tx"""))
def r2(spark, sf):
    root = new_folder(spark, "sinks")
    flows.wait(flows.start_multi_sink(tx_stream(spark, sf), root))
    parts = [flows.current_profiles(spark, root).agg(F.lit("profile").alias("sink"), F.count(F.lit(1)).alias("n"))]
    parts += [spark.read.parquet(f"{root}/{s}").agg(F.lit(s).alias("sink"), F.count(F.lit(1)).alias("n")) for s in flows.SINKS[1:]]
    return J.merge_feeds(parts)


@query("r3_chosen_sinks", sql("tx", "SELECT 'cache,profile' AS absent, count(*) AS stored FROM tx"))
def r3(spark, sf):
    from bankweave.session import path_exists

    root = new_folder(spark, "toggles")
    flows.wait(flows.start_multi_sink(tx_stream(spark, sf), root, sinks=("warehouse", "distribution")))
    absent = ",".join(sorted(s for s in flows.SINKS if not path_exists(spark, f"{root}/{s}")))
    return spark.read.parquet(f"{root}/warehouse").agg(F.count(F.lit(1)).alias("stored")).select(F.lit(absent).alias("absent"), "stored")


@query("k3_append_existing", sql("tx", "SELECT bank_entity, count(*) AS n FROM tx GROUP BY 1"))
def k3(spark, sf):
    root, stream = new_folder(spark, "existing"), tx_stream(spark, sf)
    K.create_table(spark, stream, f"{root}/transactions")
    flows.wait(flows.start_existing(stream, f"{root}/transactions", f"{root}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{root}/transactions").groupBy("bank_entity").agg(F.count(F.lit(1)).alias("n"))


@query("r4_dedup_stream", sql("tx", "SELECT transaction_id, amount FROM tx"))
def r4(spark, sf):
    """Every message is delivered twice and counted once."""
    once = tx_stream(spark, sf)
    twice = once.unionByName(tx_stream(spark, sf))
    return flows.run_to_table(flows.dedup(twice).select("transaction_id", "amount"), "dedup")


@query("r5_tumbling_kpis", sql("kpis", "SELECT bank_entity, window_start, window_end, kpi_name, kpi_value, dimensions FROM kpis"))
def r5(spark, sf):
    counts = flows.run_to_table(flows.tumbling_kpis(tx_stream(spark, sf)), "kpis", "update")
    return A.kpi_rows(flows.newest(counts, ["window_start", "window_end", "bank_entity"])).drop("kpi_id")


@query("r6_sliding_stream", sql("tx", SLIDING))
def r6(spark, sf):
    counts = flows.run_to_table(flows.sliding_velocity(tx_stream(spark, sf)), "sliding", "update")
    return flows.newest(counts, ["customer_id", "window_start", "window_end"])


@query("r7_sessions_stream", sql("tx", f"""
    SELECT * EXCLUDE (session_no) FROM ({SESSIONS}) WHERE session_end <= (SELECT max(transaction_timestamp) FROM tx) - INTERVAL 10 MINUTE"""))
def r7(spark, sf):
    """Closed sessions: a session is emitted once the watermark, ten minutes behind the newest event, has passed its end."""
    return flows.run_to_table(flows.customer_sessions(tx_stream(spark, sf)), "sessions")


@query("r8_last_values", sql("tx", LATEST.format(cols="""bank_entity, customer_id, transaction_timestamp, transaction_id, amount, transaction_type,
      channel, fraud_score, status""")))
def r8(spark, sf):
    updates = flows.run_to_table(flows.last_values(tx_stream(spark, sf)), "last", "update")
    return flows.newest(updates, ["bank_entity", "customer_id"])


@query("r9_live_cache", sql("tx", """
    SELECT 'txn:' || transaction_id AS cache_key, transaction_id, status, processing_timestamp FROM tx
    WHERE processing_timestamp > TIMESTAMP '2024-01-20 10:30:00' AND processing_timestamp <= TIMESTAMP '2024-01-20 11:30:00'"""))
def r9(spark, sf):
    """Entries alive at a moment; hours that have expired by then are gone."""
    root, now = new_folder(spark, "live"), "2024-01-20 11:30:00"
    late_arrivals(spark, sf, root, lambda stream: flows.start_multi_sink(stream, root, sinks=("cache",)))
    flows.purge_cache(spark, root, now)
    return flows.live_cache(spark, root, now).select("cache_key", "transaction_id", "status", "processing_timestamp")


@query("r10_late_rows", sql("tx", "SELECT transaction_id, d AS tx_date FROM tx"))
def r10(spark, sf):
    """Rows that come weeks behind newer ones are stored like others, and a replay adds nothing."""
    root = new_folder(spark, "late")
    late_arrivals(spark, sf, root, lambda stream: flows.start_multi_sink(flows.dedup(stream), root, sinks=("warehouse",)))
    K.append_new(fx.tx(spark, sf), f"{root}/warehouse")
    return spark.read.parquet(f"{root}/warehouse").select("transaction_id", "tx_date")


@query("r8_profiles_by_snapshot", sql("tx", LATEST.format(cols="""bank_entity, customer_id, transaction_timestamp, transaction_id, amount, transaction_type,
      channel, fraud_score, status""")))
def r8_profiles(spark, sf):
    """Profiles folded into a snapshot on the way, read as the snapshot and the batches after it."""
    root = new_folder(spark, "profiles")
    late_arrivals(spark, sf, root, lambda stream: flows.start_multi_sink(stream, root, sinks=("profile",), compact_every=2))
    return flows.current_profiles(spark, root)


@query("k15_k16_stream_layout", sql("tx prof", """
    SELECT transaction_id, t.customer_id, d AS tx_date FROM tx t WHERE d >= DATE '2024-01-17'
      AND t.customer_id NOT IN (SELECT customer_id FROM prof WHERE country_code = 'NATION_3')"""))
def stream_layout(spark, sf):
    """One table: filled by a stream, replayed later, with customers erased and old days dropped."""
    root = new_folder(spark, "layout")
    table = f"{root}/warehouse"
    late_arrivals(spark, sf, root, lambda stream: flows.start_multi_sink(stream, root, sinks=("warehouse",)))
    K.append_new(fx.tx(spark, sf).withColumn("processing_timestamp", F.lit("2024-03-01").cast("timestamp")), table)
    K.erase_customers(spark, table, fx.profiles(spark, sf).filter(F.col("country_code") == "NATION_3").select("customer_id"))
    K.expire(spark, table, fx.AS_OF, days=14)
    return spark.read.parquet(table).select("transaction_id", "customer_id", "tx_date")


@query("j5_follow_up_stream", sql("tx", FOLLOW_UPS))
def j5(spark, sf):
    out = flows.follow_up_stream(tx_stream(spark, sf))
    return flows.run_to_table(out.select("transaction_id", "customer_id", "bank_entity", "status", "transaction_timestamp"), "follow")


@query("r13_subscribers", sql("tx", "SELECT bank_entity, transaction_id, status, amount FROM tx"))
def r13(spark, sf):
    """Each bank drains its own folders with a query and a checkpoint of its own; a repeated batch is delivered once."""
    root = new_folder(spark, "subscribers")
    late_arrivals(spark, sf, root, lambda stream: flows.start_multi_sink(stream, root, sinks=("distribution",)))

    def drain() -> None:
        started = [flows.start_subscriber(spark, root, b, f"{root}/out/{b}", f"{root}/progress/{b}") for b in fx.BANKS]
        for q in started:
            flows.wait(q)

    drain()
    again = spark.read.parquet(f"{root}/distribution").filter("batch_id = 0").drop("batch_id").select("bank_entity", "transaction_id", "message")
    flows._write_batch(stage(again, "again"), f"{root}/distribution", 0, ["bank_entity"])
    drain()
    got = spark.read.schema("transaction_id string, message string, bank_entity string").option("recursiveFileLookup", True).parquet(f"{root}/out/*")
    body = F.from_json("message", "status string, amount double")
    return got.withColumn("m", body).select("bank_entity", "transaction_id", "m.status", "m.amount")
