"""Sinks: idempotence, retention, erasure, schema guard, batch and retry jobs."""

import os

import pytest
from pyspark.sql import functions as F

from bankweave import schemas as S
from bankweave.functions import ts_lit
from bankweave.operators import aggregates as A
from bankweave.operators import tables as K
from bankweave.operators import validate as V
from bankweave.plans import jobs
from bankweave.session import new_folder, partition_values
from bankweave.sources import files, generate
from bankweave.sources import fixtures as fx
from bankweave.streaming import flows


def content(spark, path):
    return sorted(map(str, spark.read.parquet(path).collect()))


def test_append_new_twice_changes_nothing(spark, sf_dir):
    path, tx = new_folder(spark, "t"), fx.tx(spark, sf_dir)
    K.append_new(tx.unionByName(tx), path)
    before = content(spark, path)
    K.append_new(tx, path)
    assert content(spark, path) == before and len(before) == tx.count()


def test_one_per_id_does_not_depend_on_order(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")]
    make = lambda data: spark.createDataFrame(data, "transaction_id string, processing_timestamp int, v string")
    got = [sorted(map(tuple, K.one_per_id(make(d)).collect())) for d in (rows, rows[::-1])]
    assert got[0] == got[1] == [("a", 1, "x"), ("b", 1, "z")]


def test_erase_removes_emptied_folders_and_leaves_others_alone(spark):
    path = new_folder(spark, "erase")
    rows = [("T1", "c1", "2024-01-01"), ("T2", "c1", "2024-01-02"), ("T3", "c2", "2024-01-02"), ("T4", "c2", "2024-01-03")]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, d string").select(
        "transaction_id", "customer_id", F.col("d").cast("timestamp").alias("transaction_timestamp"))
    K.write_transactions(df, path)
    local = path.removeprefix("file:")
    untouched = {f: os.stat(f"{local}/tx_date=2024-01-03/{f}").st_mtime_ns for f in os.listdir(f"{local}/tx_date=2024-01-03")}
    ids = spark.createDataFrame([("c1",)], "customer_id string")
    assert K.erase_customers(spark, path, ids) == ["2024-01-01", "2024-01-02"]
    assert sorted(r.transaction_id for r in spark.read.parquet(path).collect()) == ["T3", "T4"]
    assert partition_values(spark, path, "tx_date") == ["2024-01-02", "2024-01-03"]
    assert untouched == {f: os.stat(f"{local}/tx_date=2024-01-03/{f}").st_mtime_ns for f in os.listdir(f"{local}/tx_date=2024-01-03")}
    assert K.erase_customers(spark, path, ids) == []


def test_undated_rows_in_erasure_retention_and_append(spark):
    path = new_folder(spark, "undated")
    rows = [("T1", "c1", None), ("T2", "c2", None), ("T3", "c1", "2024-01-02"), ("T4", "c2", "2023-01-02")]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, d string").select(
        "transaction_id", "customer_id", F.col("d").cast("timestamp").alias("transaction_timestamp"))
    K.append_new(df, path)
    K.append_new(df.withColumn("transaction_timestamp", F.lit("2024-05-05").cast("timestamp")), path)
    assert spark.read.parquet(path).count() == 4
    assert K.erase_customers(spark, path, spark.createDataFrame([("c1",)], "customer_id string")) == ["2024-01-02", "None"]
    assert K.expire(spark, path, "2024-01-31") == ["2023-01-02"]
    assert [r.transaction_id for r in spark.read.parquet(path).collect()] == ["T2"]
    K.erase_customers(spark, path, spark.createDataFrame([("c2",)], "customer_id string"))
    assert partition_values(spark, path, "tx_date") == []


def test_overlapping_runs_replace_days(spark, sf_dir):
    path = new_folder(spark, "runs")
    tx = fx.tx(spark, sf_dir)
    for _ in range(2):
        K.append_branches(A.branch_volume(tx), path)
    assert spark.read.parquet(path).count() == A.branch_volume(tx).count()


def test_expire_drops_whole_folders(spark, sf_dir):
    path = new_folder(spark, "expire")
    K.write_transactions(fx.tx(spark, sf_dir), path)
    dropped = K.expire(spark, path, "2024-01-31 00:00:00", days=10)
    assert dropped[0] == "2024-01-01" and dropped[-1] == "2024-01-20"
    assert min(partition_values(spark, path, "tx_date")) == "2024-01-21"


def test_sink_refuses_to_create_or_change_a_table(spark, sf_dir):
    stream, root = fx.from_events(files.read_stream(spark, sf_dir, fx.table(spark, sf_dir, "events").schema, "parquet", glob="events.parquet")), new_folder(spark, "guard")
    with pytest.raises(FileNotFoundError):
        flows.start_existing(stream, f"{root}/none", f"{root}/c")
    K.create_table(spark, stream.drop("is_fraud"), f"{root}/table")
    with pytest.raises(ValueError):
        flows.start_existing(stream, f"{root}/table", f"{root}/c")


def test_history_with_gaps(spark):
    path = new_folder(spark, "csv")
    header = ",".join(K.EXPORT_COLUMNS)
    good = "T1,b,c,PAYMENT,1.5,USD,,,,APP,APPROVED,0.1,,,2024-01-05T00:00:00.000000,,0"
    rows = [good, good.replace("1.5", "abc"), good.replace("T1", "")]
    spark.createDataFrame([("\n".join([header, *rows]),)], "value string").coalesce(1).write.text(path)
    ok, gaps = files.read_history(spark, path)
    assert [r.transaction_id for r in ok.collect()] == ["T1"]
    assert sorted(r.gaps[0] for r in gaps.collect()) == ["null amount", "null transaction_id"]


def test_export_fills_absent_columns(spark, sf_dir):
    path = new_folder(spark, "export")
    K.export_csv(fx.tx(spark, sf_dir).drop("branch_id"), path)
    df = spark.read.option("header", True).csv(path)
    assert df.columns == K.EXPORT_COLUMNS and df.filter("branch_id is not null").count() == 0


def test_daily_batch(spark, sf_dir):
    root = new_folder(spark, "batch")
    K.export_csv(fx.tx(spark, sf_dir), f"{root}/history")
    result = jobs.daily_batch(spark, f"{root}/history", f"{root}/out", fx.AS_OF, 14, maxIter=5, maxDepth=3)
    expected = files.lookback(fx.tx(spark, sf_dir), fx.AS_OF, 14).count()
    assert result["loaded"] == expected == result["train"] + result["test"]
    assert result["read"] == fx.tx(spark, sf_dir).count() and result["incomplete"] == 0
    assert result["auc"] > 0.9 and os.path.exists(result["model"].removeprefix("file:"))
    for table in ("movement_trends", "liquidity_forecast", "branch_volume_metrics"):
        assert spark.read.parquet(f"{root}/out/{table}").count() > 0


def test_retry_readmits_once_the_cause_is_gone(spark, sf_dir):
    root = new_folder(spark, "retry")
    messages = fx.messages(spark, sf_dir)
    V_all = V.validate(messages, fx.BANKS[:6])  # half of the banks are not registered yet
    K.append_quarantine(V.quarantine(V_all, ts_lit("2024-01-31 00:00:00")), f"{root}/q")
    passing = V.storable(messages, ts_lit("2024-01-31 00:00:00"), fx.BANKS).filter(F.size("errors") == 0)
    unknown = passing.filter(~F.col("bank_entity").isin(fx.BANKS[:6])).count()
    for at in ("2024-01-31 00:00:05", "2024-01-31 00:01:00", "2024-01-31 01:00:00"):
        jobs.retry_quarantine(spark, f"{root}/q", f"{root}/t", at, fx.BANKS)
    assert spark.read.parquet(f"{root}/t").count() == unknown > 0
    log = spark.read.parquet(f"{root}/q")
    assert log.filter(F.size("errors") == 0).count() == unknown
    assert log.agg(F.max("attempt")).first()[0] == 3


def test_warehouse_rows_have_the_declared_schema(spark, sf_dir):
    rows = fx.tx(spark, sf_dir).withColumn("metadata", F.lit(None).cast("string"))
    assert files.as_market(rows, "transactions").dtypes == [(f.name, f.dataType.simpleString()) for f in S.TRANSACTIONS.fields]
    bad = rows.withColumn("customer_id", F.lit(None).cast("string")).withColumn("amount", F.lit(1e30)).limit(1)
    assert bad.select(V.warehouse_gaps()).first()[0] == ["null customer_id", "amount out of range"]


def test_synthetic_shape_and_repeatability(spark):
    base = spark.range(20000)
    one = generate.synthetic(base, fx.AS_OF, 90, seed=1)
    two = generate.synthetic(base.repartition(3), fx.AS_OF, 90, seed=1)
    assert one.exceptAll(two).count() == 0
    s = one.agg(
        F.avg("is_fraud").alias("fraud"), F.count_distinct("transaction_id").alias("ids"), F.count_distinct("bank_entity").alias("banks"),
        F.avg(F.when(F.col("is_fraud") == 0, (F.col("status") == "APPROVED").cast("int"))).alias("ok"),
        F.avg(F.when(F.col("is_fraud") == 0, (F.col("status") == "REJECTED").cast("int"))).alias("no"),
        F.percentile_approx(F.when(F.col("transaction_type") == "TRANSFER", F.ln("amount")), 0.5).alias("mu"),
        F.stddev(F.when(F.col("transaction_type") == "TRANSFER", F.ln("amount"))).alias("sigma"),
        F.min(F.when(F.col("is_fraud") == 1, F.col("fraud_score"))).alias("lo"), F.max(F.when(F.col("is_fraud") == 0, F.col("fraud_score"))).alias("hi"),
        F.max(F.when(F.col("transaction_type") == "WITHDRAWAL", F.col("amount"))).alias("w"),
        F.count_if((F.col("channel") == "APP") != F.col("device_id").isNotNull()).alias("bad_device"),
        F.count_if((F.col("channel") == "APP") != F.col("branch_id").isNull()).alias("bad_branch"),
        F.datediff(F.max("transaction_timestamp"), F.min("transaction_timestamp")).alias("days")).first()
    assert abs(s.fraud - 0.03) < 0.005 and s.ids == 20000 and s.banks == 12
    assert abs(s.ok - 0.85) < 0.01 and abs(s.no - 0.05) < 0.01
    assert abs(s.mu - 6) < 0.1 and abs(s.sigma - 2) < 0.1
    assert s.lo >= 0.8 and s.hi <= 0.3 and s.w <= 500 and s.bad_device == 0 and s.bad_branch == 0 and 89 <= s.days <= 91


def test_replay_selects_arrival_range_and_bank(spark):
    df = spark.sql("select date'2024-01-01' + cast(id as int) arrival_date, concat('b', id % 2) bank_entity from range(10)")
    assert files.replay(df, "2024-01-03", "2024-01-07", "b0").count() == 2
    assert files.replay(df, "2024-01-03").count() == 8


@pytest.mark.parametrize("name", sorted(set(S.FEEDS) - {"transactions"}))
def test_every_file_feed_reads_back(spark, name):
    fmt, schema = S.FEEDS[name]
    path = new_folder(spark, "feed")
    writer = spark.createDataFrame([], schema).write
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)
    df = files.read_feed(spark, name, path)
    assert df.columns == [*schema.fieldNames(), "source_file", "source_modified_at", "feed"] and df.count() == 0
