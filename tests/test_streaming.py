"""Streams against their batch twins, and idempotent sinks."""

import json

import pytest
from pyspark.sql import functions as F

from bankweave.operators import windows as W
from bankweave.plans import jobs, streams
from bankweave.session import new_folder
from bankweave.sources import files
from bankweave.sources import fixtures as fx
from bankweave.streaming import flows


def test_closed_sessions_equal_batch(spark, sf_dir):
    stream = flows.run_to_table(flows.customer_sessions(streams.tx_stream(spark, sf_dir)), "s")
    batch = W.sessions(fx.tx(spark, sf_dir)).select(*stream.columns)
    closed, every = set(map(tuple, stream.collect())), set(map(tuple, batch.collect()))
    assert closed < every
    last = max(r[2] for r in closed)
    # Only sessions near the end of the data are still open.
    assert min(r[2] for r in every - closed) >= last


def test_several_batches_give_the_same_current_values(spark, sf_dir):
    root = new_folder(spark, "split")
    fx.tx(spark, sf_dir).repartition(5).write.parquet(f"{root}/in")
    stream = files.read_stream(spark, f"{root}/in", fx.tx(spark, sf_dir).schema, "parquet", max_files=1)
    updates = flows.run_to_table(flows.last_values(stream), "u", "update")
    assert updates.select("batch_id").distinct().count() >= 5
    now = flows.newest(updates, ["bank_entity", "customer_id"])
    batch = flows.last_values(fx.tx(spark, sf_dir)).select(*now.columns)
    assert sorted(map(str, now.collect())) == sorted(map(str, batch.collect()))


def test_repeated_batch_writes_the_same_output(spark, sf_dir):
    folder = new_folder(spark, "again")
    tx = fx.tx(spark, sf_dir)
    for _ in range(2):
        flows._write_batch(tx, folder, 0, ("bank_entity",))
    flows._write_batch(tx.limit(0), folder, 1, ("bank_entity",))
    assert spark.read.parquet(folder).count() == tx.count()


def test_late_rows_are_kept_and_duplicates_dropped(spark):
    root = new_folder(spark, "late")
    schema = "transaction_id string, transaction_timestamp timestamp"
    batches = [[("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:01:00"), ("b", "2099-01-01 15:00:00")],
               [("c", "2024-01-01 09:00:00"), ("b", "2024-01-01 15:00:00"), ("d", "2024-01-01 15:30:00")]]
    for rows in batches:
        spark.createDataFrame(rows, "transaction_id string, transaction_timestamp string").coalesce(1).write.mode("append").json(f"{root}/in")
        stream = files.read_stream(spark, f"{root}/in", spark.createDataFrame([], schema).schema, "json", max_files=1)
        flows.wait(flows.start(flows.dedup(stream), f"{root}/out", f"{root}/c"))
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b", "c", "d"]


def test_unstorable_messages_go_to_quarantine(spark):
    root = new_folder(spark, "faulty")
    good = {"bank_entity": "banco-sur-cooperativo", "customer_id": "C", "transaction_type": "DEPOSIT", "amount": 3, "currency": "USD", "channel": "ATM", "transaction_id": "T1"}
    odd = [{"customer_id": None}, {"transaction_timestamp": "yesterday"}, {"amount": 1e30}, {"amount": 1e17}, {"transaction_timestamp": "2099-01-01T00:00:00"}]
    lines = [json.dumps({**good, **o, "transaction_id": f"T{i}"}) + end for i, o in enumerate(odd) for end in (" \t",)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/in")
    for q in jobs.message_stream(spark, f"{root}/in", f"{root}/out"):
        flows.wait(q)
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{root}/out/warehouse").collect()) == ["T3", "T4"]
    reasons = sorted(r.errors[0] for r in spark.read.parquet(f"{root}/out/quarantine").collect())
    assert reasons == ["amount out of range", "null customer_id", "null transaction_timestamp"]
    for sink in ("cache", "distribution"):
        assert spark.read.parquet(f"{root}/out/{sink}").count() == 2


def test_message_stream_job(spark, sf_dir):
    root = new_folder(spark, "job")
    good = {"bank_entity": "banco-sur-cooperativo", "customer_id": "C", "transaction_type": "DEPOSIT", "amount": 3, "currency": "USD",
            "channel": "ATM", "transaction_id": "T1", "transaction_timestamp": "2024-01-01T10:00:00", "branch_id": "S"}
    lines = [json.dumps(good), json.dumps(good), json.dumps({**good, "transaction_id": "T2", "amount": 0}), "broken"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/in")
    for q in jobs.message_stream(spark, f"{root}/in", f"{root}/out"):
        flows.wait(q)
    stored = spark.read.parquet(f"{root}/out/warehouse").collect()
    assert [(r.transaction_id, r.amount, r.bank_entity) for r in stored] == [("T1", 3.0, "banco-sur-cooperativo")]
    assert spark.read.parquet(f"{root}/out/quarantine").count() == 2
    message = json.loads(spark.read.parquet(f"{root}/out/distribution").first().message)
    assert set(message) == {"transaction_id", "bank_entity", "customer_id", "status", "amount", "currency", "fraud_score", "processing_timestamp"}
    flows.compact_profiles(spark, f"{root}/out")
    assert flows.current_profiles(spark, f"{root}/out").count() == 1


def test_unknown_sink_is_refused(spark, sf_dir):
    with pytest.raises(ValueError):
        flows.start_multi_sink(streams.tx_stream(spark, sf_dir), new_folder(spark, "x"), sinks=("mail",))


def test_subscriber_goes_on_where_it_stopped(spark, sf_dir):
    root, bank = new_folder(spark, "sub"), "bank-03"
    for number, part in enumerate(("< '2024-01-10'", ">= '2024-01-10'")):
        rows = fx.tx(spark, sf_dir).filter(f"transaction_timestamp {part}")
        flows._write_batch(flows.validate.distribution(rows), f"{root}/distribution", number, ("bank_entity",))
        flows.wait(flows.start_subscriber(spark, root, bank, f"{root}/out", f"{root}/progress"))
    got = spark.read.parquet(f"{root}/out")
    assert got.count() == got.select("transaction_id").distinct().count() == fx.tx(spark, sf_dir).filter(F.col("bank_entity") == bank).count()


def test_a_micro_batch_writes_one_file_for_a_small_day(spark, sf_dir):
    """Adaptive execution is off in a stream's session, and without it every shuffle partition writes into every day."""
    from bankweave.session import data_sizes

    days = fx.tx(spark, sf_dir).select(F.to_date("transaction_timestamp")).distinct().count()
    for name, run in (("settled", lambda s, root: flows.start_settled(s, f"{root}/warehouse", f"{root}/c", index_from=0)),
                      ("sinks", lambda s, root: flows.start_multi_sink(flows.dedup(s), root, sinks=("warehouse",)))):
        root = new_folder(spark, name)
        flows.wait(run(streams.tx_stream(spark, sf_dir), root))
        assert len(data_sizes(spark, f"{root}/warehouse")) == days
        assert spark.read.parquet(f"{root}/warehouse").count() == fx.tx(spark, sf_dir).count()
