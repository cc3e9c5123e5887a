"""Membership index, compaction, tiers, sketches and the cache as state: against plain versions, and killed at every step."""

import random

import pytest
from pyspark.sql import functions as F

from bankweave.operators import idindex, layout
from bankweave.operators import sketches as SK
from bankweave.operators import tables as K
from bankweave.session import data_sizes, new_folder, partition_values, path_exists, read_text, write_text
from bankweave.sources import files
from bankweave.streaming import state

TX = "transaction_id string, customer_id string, bank_entity string, transaction_type string, status string, amount double, transaction_timestamp timestamp"


def rows_of(n, days, seed, start=0, undated=True):
    rng = random.Random(seed)
    stamp = lambda: f"2024-01-{rng.randint(1, days):02d} 10:00:00" if not undated or rng.random() > 0.05 else None
    return [(f"T{start + i}", f"c{rng.randrange(40)}", f"bank-{i % 3}", rng.choice(["DEPOSIT", "PAYMENT"]), "APPROVED", rng.random() * 100, stamp()) for i in range(n)]


def frame(spark, rows):
    kinds = TX.replace("transaction_timestamp timestamp", "t string")
    return spark.createDataFrame(rows, kinds).withColumn("transaction_timestamp", F.col("t").cast("timestamp")).drop("t")


def content(spark, path, *drop):
    return sorted(map(str, spark.read.parquet(path).drop("load", *drop).collect()))


# ---- membership index

def test_filters_never_miss_and_seldom_err(spark):
    path = new_folder(spark, "idx")
    K.write_transactions(frame(spark, rows_of(6000, 9, 1)), path)
    table = spark.read.parquet(path)
    new = idindex.refresh(spark, path)
    assert set(new) == set(data_sizes(spark, path)) and idindex.refresh(spark, path) == []
    where = {r["transaction_id"]: r["f"] for r in table.select("transaction_id", idindex.file_name().alias("f")).collect()}
    rng = random.Random(2)
    for _ in range(4):
        ids = rng.sample(sorted(where), 3)
        asked = spark.createDataFrame([(i,) for i in [*ids, None]], "transaction_id string")
        hits = {h.removeprefix(f"{path}/") for h in idindex.may_hold(spark, path, asked)}
        assert {where[i] for i in ids} == hits
    strangers = spark.range(200_000).select(F.concat(F.lit("X"), "id").alias("transaction_id"))
    assert idindex.may_hold(spark, path, strangers) == []
    assert idindex.false_hits(1_000_000, 1000) < 20
    assert idindex.may_hold(spark, path, strangers.limit(0)) == [] == idindex.may_hold(spark, new_folder(spark, "none"), strangers)


def test_sizes_of_filters_follow_the_files(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, "a=1/x").when(F.col("id") < 4001, "a=2/y").otherwise("z").alias("file"), F.col("id").cast("string").alias("k"))
    cells = {(r["file"], r["bitmaps"], r["bitmap"]) for r in idindex.filters(rows, "k").collect()}
    assert {f: b for f, b, _ in cells} == {"a=1/x": 8, "a=2/y": 1, "z": 2}
    assert len([c for c in cells if c[0] == "a=1/x"]) == 8


def test_append_sees_files_of_other_writers_and_null_ids(spark):
    path, rows = new_folder(spark, "others"), rows_of(300, 5, 3)
    K.append_new(frame(spark, rows[:100]), path, index_from=0)
    K.write_transactions(frame(spark, rows[100:200]), path, load="elsewhere")  # knows nothing of the index
    K.append_new(frame(spark, rows), path, index_from=0)
    K.append_new(frame(spark, rows[::-1]), path, index_from=0)
    ids = [r["transaction_id"] for r in spark.read.parquet(path).collect()]
    assert sorted(ids) == sorted(r[0] for r in rows)
    K.append_new(frame(spark, [(None, *rows[0][1:])]), path, index_from=0)
    assert spark.read.parquet(path).filter("transaction_id IS NULL").count() == 1


def test_appending_a_day_reads_no_other(spark):
    path = new_folder(spark, "days")
    for day in range(1, 8):
        rows = [(f"D{day}-{i}", "c", "b", "PAYMENT", "APPROVED", 1.0, f"2024-02-{day:02d} 00:00:00") for i in range(50)]
        K.append_new(frame(spark, rows), path, index_from=0)
    idindex.refresh(spark, path)
    fresh = spark.createDataFrame([(f"D8-{i}",) for i in range(50)], "transaction_id string")
    assert idindex.may_hold(spark, path, fresh) == [] and idindex.held(spark, path, fresh).count() == 0
    third = idindex.may_hold(spark, path, spark.createDataFrame([("D3-7",)], "transaction_id string"))
    assert len(third) == 1 and "tx_date=2024-02-03" in third[0]


def test_erasure_forgets_the_customers(spark):
    path, rows = new_folder(spark, "forget"), rows_of(400, 6, 4)
    K.append_new(frame(spark, rows), path, index_from=0)
    K.append_new(frame(spark, rows_of(50, 9, 5, start=1000)), path, load="second", index_from=0)
    ids = spark.createDataFrame([("c1",), ("c2",), ("nobody",), (None,)], "customer_id string")
    before = [r for r in spark.read.parquet(path).collect()]
    K.erase_customers(spark, path, ids, index_from=0)
    assert sorted(map(str, (r for r in before if r["customer_id"] not in ("c1", "c2")))) == sorted(map(str, spark.read.schema(spark.read.parquet(path).schema).parquet(path).collect()))
    assert K.erase_customers(spark, path, ids, index_from=0) == []
    for key in ("customer_id", "transaction_id"):
        held = {r["file"] for r in spark.read.parquet(idindex.index_path(path, key)).collect()}
        assert held <= set(data_sizes(spark, path))
    K.append_new(frame(spark, rows), path, index_from=0)  # the first load's come again
    gone = sum(r["customer_id"] in ("c1", "c2") and r["load"] == "second" for r in before)
    assert spark.read.parquet(path).count() == len(before) - gone


# ---- compaction

def test_first_fit_decreasing():
    assert layout.first_fit_decreasing({"a": 6, "b": 5, "c": 4, "d": 3, "e": 11}, 10) == [["e"], ["a", "c"], ["b", "d"]]
    assert layout.first_fit_decreasing({}, 10) == []
    rng = random.Random(6)
    for _ in range(50):
        sizes = {str(i): rng.randint(1, 60) for i in range(rng.randint(1, 40))}
        bins = layout.first_fit_decreasing(sizes, 100)
        assert sorted(n for b in bins for n in b) == sorted(sizes) and all(sum(sizes[n] for n in b) <= 100 for b in bins)
        assert sum(sum(sizes[n] for n in b) <= 50 for b in bins) <= 1  # two half empty bins would be one


def many_loads(spark, path):
    for load in range(5):
        K.write_transactions(frame(spark, rows_of(120, 4, load, start=1000 * load)), path, load=f"stream-{load}")


def test_compaction_keeps_rows_and_bounds_files(spark):
    path = new_folder(spark, "compact")
    many_loads(spark, path)
    before, loads = content(spark, path), len(data_sizes(spark, path))
    plan = layout.compact(spark, path, skip_loads=("stream-4",))
    sizes = data_sizes(spark, path)
    assert content(spark, path) == before and len(sizes) < loads
    days = {n.partition("/")[0] for n in sizes}
    assert all(sum(n.startswith(f"{d}/load=merged") for n in sizes) == 1 for d in days) and any("load=stream-4" in n for n in sizes)
    assert f"tx_date={K.NO_VALUE}" in {f.partition("/")[0] for f in plan}
    merged = spark.read.parquet(path).filter("load LIKE 'merged%'")
    for part in merged.select("tx_date").distinct().collect():
        keys = [tuple(r) for r in merged.filter(F.col("tx_date").eqNullSafe(part[0])).select(*K.CLUSTER).collect()]
        assert keys == sorted(keys)
    assert layout.compact(spark, path, skip_loads=("stream-4",)) == {} and not path_exists(spark, f"{path}_compact")
    assert layout.compact(spark, path, target=10) == {}  # every file is over half of this


@pytest.mark.parametrize("step", ["write", "plan", "move", "delete"])
def test_compaction_goes_on_after_a_kill(spark, step):
    path = new_folder(spark, "killed")
    many_loads(spark, path)
    before = content(spark, path)
    layout.compact(spark, path, stop_after=step)
    layout.compact(spark, path)
    assert content(spark, path) == before
    sizes = data_sizes(spark, path)
    assert len(sizes) == len({n.partition("/")[0] for n in sizes})


# ---- tiers

def test_old_days_move_and_recent_queries_stay_away(spark):
    root = new_folder(spark, "tiers")
    hot, cold = f"{root}/hot", f"{root}/cold"
    K.write_transactions(frame(spark, rows_of(500, 20, 7)), hot)
    before = content(spark, hot)
    moved = layout.move_cold(spark, hot, cold, "2024-01-20", days=5)
    assert moved == [f"2024-01-{d:02d}" for d in range(1, 15)]
    assert min(d for d in partition_values(spark, hot, "tx_date") if d != K.NO_VALUE) == "2024-01-15"
    assert partition_values(spark, cold, "tx_date") == moved
    whole = layout.read_tiers(spark, hot, cold, "2024-01-20", days=5)
    assert sorted(map(str, whole.drop("load", "tier").collect())) == before
    recent = layout.read_tiers(spark, hot, cold, "2024-01-20", since="2024-01-16", days=5)
    assert not any("/cold/" in f for f in recent.inputFiles()) and recent.filter("tier = 'COLD'").count() == 0
    some = layout.read_tiers(spark, hot, cold, "2024-01-20", since="2024-01-12", days=5)
    assert {f.split("tx_date=")[1][:10] for f in some.inputFiles() if "/cold/" in f} == {"2024-01-12", "2024-01-13", "2024-01-14"}
    assert layout.move_cold(spark, hot, cold, "2024-01-20", days=5) == []


@pytest.mark.parametrize("step", ["write", "note", "move", "delete"])
def test_a_killed_move_loses_and_doubles_nothing(spark, step):
    root = new_folder(spark, "moves")
    hot, cold = f"{root}/hot", f"{root}/cold"
    K.write_transactions(frame(spark, rows_of(200, 4, 8)), hot)
    layout.move_cold(spark, hot, cold, "2024-01-20", days=17)
    K.write_transactions(frame(spark, rows_of(60, 4, 9, start=5000)), hot, load="late")  # for days that have moved
    every = sorted(map(str, layout.read_tiers(spark, hot, cold, "2024-01-20", days=17).drop("load", "tier").collect()))
    assert len(every) == 260
    layout.move_cold(spark, hot, cold, "2024-01-20", days=17, stop_after=step)
    read = lambda: sorted(map(str, layout.read_tiers(spark, hot, cold, "2024-01-20", days=17).drop("load", "tier").collect()))
    assert read() == every
    K.write_transactions(frame(spark, rows_of(1, 1, 10, start=9000, undated=False)), hot, load="later")  # comes while the move lies there
    layout.move_cold(spark, hot, cold, "2024-01-20", days=17)
    assert len(read()) == 261 and set(every) < set(read())
    assert not path_exists(spark, f"{cold}_moving") and [d for d in partition_values(spark, hot, "tx_date") if d < "2024-01-03"] == []


def test_small_files_are_whole(spark):
    path = new_folder(spark, "note") + "/a/b.json"
    assert read_text(spark, path) is None
    for text in ("x" * 5000, "ü", ""):
        write_text(spark, path, text)
        assert read_text(spark, path) == text


# ---- sketches

def test_counts_merge_and_stay_within_their_error(spark):
    tx = spark.range(60_000).select(
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("customer_id"), F.lit("b").alias("bank_entity"), (F.col("id") % 7).cast("double").alias("amount"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(60)) * 86_400).alias("transaction_timestamp"))
    exact = {r["p"]: r["n"] for r in tx.groupBy(F.date_trunc("month", "transaction_timestamp").cast("date").alias("p")).agg(F.count_distinct("customer_id").alias("n")).collect()}
    for lg in (10, 14):
        rows = SK.customers_by(SK.customer_sketches(tx, lg), lg=lg).collect()
        raw = tx.groupBy(F.date_trunc("month", "transaction_timestamp").cast("date").alias("p")).agg(F.theta_sketch_estimate(F.theta_sketch_agg("customer_id", lg)).alias("n"))
        whole = {r["p"]: r["n"] for r in raw.collect()}
        for r in rows:
            assert abs(r["unique_customers"] - exact[r["period"]]) <= SK.count_error(lg) * exact[r["period"]]
            assert abs(r["unique_customers"] - whole[r["period"]]) <= SK.count_error(lg) * exact[r["period"]]
    empty = SK.customers_by(SK.customer_sketches(tx.limit(0)))
    assert empty.count() == 0
    lone = SK.customers_by(SK.customer_sketches(tx.limit(5).withColumn("customer_id", F.lit(None).cast("string")))).collect()
    assert [(r["unique_customers"], r["gained"], r["lost"]) for r in lone] == [(0, 0, 0)] * len(lone)


def test_medians_merge_within_their_rank_error(spark):
    tx = spark.range(100_000).select(
        F.lit("b").alias("bank_entity"), F.lit("s").alias("branch_id"), F.lit("APP").alias("channel"), F.exp(F.randn(3) * 2).alias("amount"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 40 * 86_400).alias("transaction_timestamp")).cache()
    row = SK.branch_medians(SK.amount_sketches(tx)).first()
    under = tx.filter(F.col("amount") < row["median_amount"]).count()
    assert row["total_transactions"] == 100_000 and abs(under / 100_000 - 0.5) <= 2 * SK.rank_error()
    nothing = SK.amount_sketches(tx.limit(3).withColumn("amount", F.lit(None).cast("double")))
    assert SK.branch_medians(nothing).first()["median_amount"] is None


# ---- cache as state

def entries(spark, rows):
    schema = "transaction_id string, bank_entity string, customer_id string, status string, processing_timestamp string"
    return spark.createDataFrame([(i, "b", "c", s, t) for i, s, t in rows], schema).withColumn("processing_timestamp", F.col("processing_timestamp").cast("timestamp"))


def test_entries_are_renewed_and_evicted_and_survive_a_restart(spark):
    root = new_folder(spark, "ttl")
    parts = [
        [("a", "NEW", "2024-01-01 10:00:00"), ("b", "NEW", "2024-01-01 10:20:00"), (None, "NEW", "2024-01-01 10:00:00"), ("n", "NEW", None)],
        [("a", "RENEWED", "2024-01-01 10:50:00"), ("b", "OLD", "2024-01-01 10:10:00"), ("c", "NEW", "2024-01-01 11:10:00")],
        [("d", "NEW", "2024-01-01 11:45:00"), ("late", "NEW", "2024-01-01 09:00:00")],
        [("e", "NEW", "2024-01-01 20:00:00")],
    ]
    want = [{"a": "NEW", "b": "NEW"}, {"a": "RENEWED", "b": "NEW", "c": "NEW"}, {"a": "RENEWED", "c": "NEW", "d": "NEW"}, {"e": "NEW"}]
    sizes = []
    for rows, left in zip(parts, want):
        entries(spark, rows).write.mode("append").parquet(f"{root}/in")
        stream = files.read_stream(spark, f"{root}/in", entries(spark, []).schema, "parquet")
        query = state.start_cache(stream, root)  # each run is a restart
        query.awaitTermination()
        sizes.append(query.lastProgress.stateOperators[0].numRowsTotal if query.lastProgress.stateOperators else None)
        assert {r["cache_key"][4:]: r["status"] for r in state.alive(spark, root).collect()} == left
        assert {r["cache_key"][4:]: r["status"] for r in state.held(spark, root).collect()} == left
    assert sizes[-1] < max(sizes)  # evicted entries leave the store
    changes = spark.read.parquet(f"{root}/changes")
    assert changes.filter("change = 'evict'").count() == 4 and changes.filter("transaction_id = 'late'").count() == 0


def test_cache_needs_no_setting_of_the_session(spark):
    """With Spark's default state store, which cannot hold an entry and its timer; the session's setting stays."""
    from bankweave.session import STATE_STORE, setting

    root, plain = new_folder(spark, "plain"), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with setting(spark, STATE_STORE, plain):
        for rows, left in (([("a", "NEW", "2024-01-01 10:00:00.5"), ("b", "NEW", "2024-01-01 10:00:00.501")], ["a", "b"]), ([("c", "NEW", "2024-01-01 11:00:00.5")], ["b", "c"])):
            entries(spark, rows).write.mode("append").parquet(f"{root}/in")
            state.start_cache(files.read_stream(spark, f"{root}/in", entries(spark, []).schema, "parquet"), root).awaitTermination()
            assert spark.conf.get(STATE_STORE) == plain
            assert sorted(r["transaction_id"] for r in state.alive(spark, root).collect()) == left
            assert sorted(r["transaction_id"] for r in state.held(spark, root).collect()) == left


def test_keys_of_one_bucket_are_put_renewed_and_evicted_alone(spark, monkeypatch):
    monkeypatch.setattr(state, "BUCKETS", 1)
    root = new_folder(spark, "bucket")
    parts = [
        ([("a", "NEW", "2024-01-01 10:00:00"), ("a", "OLD", "2024-01-01 09:59:00"), ("b", "NEW", "2024-01-01 10:20:00")], {"a": "NEW", "b": "NEW"}),
        ([("a", "RENEWED", "2024-01-01 10:50:00"), ("b", "OLD", "2024-01-01 10:10:00"), ("c", "NEW", "2024-01-01 11:20:00")], {"a": "RENEWED", "c": "NEW"}),
        ([("d", None, "2024-01-01 11:50:00.000001")], {"c": "NEW", "d": None}),
    ]
    for rows, left in parts:
        entries(spark, rows).write.mode("append").parquet(f"{root}/in")
        state.start_cache(files.read_stream(spark, f"{root}/in", entries(spark, []).schema, "parquet"), root).awaitTermination()
        for read in (state.alive, state.held):
            assert {r["transaction_id"]: r["status"] for r in read(spark, root).collect()} == left
    changes = spark.read.parquet(f"{root}/changes")
    assert sorted((r["change"], r["transaction_id"], r["status"]) for r in changes.filter("transaction_id <> 'd'").collect()) == [
        ("evict", "a", "RENEWED"), ("evict", "b", "NEW"), ("put", "a", "NEW"), ("put", "a", "RENEWED"), ("put", "b", "NEW"), ("put", "c", "NEW")]
