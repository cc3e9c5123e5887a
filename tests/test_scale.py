"""Sliced operators against brute force, with a third of all rows under one key."""

from collections import defaultdict
from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from bankweave.operators import joins as J
from bankweave.operators import windows as W
from bankweave.operators.scale import asof_last, latest_by, percent_rank

START = datetime(2024, 1, 1)
SCHEMA = "transaction_id string, customer_id string, bank_entity string, amount double, transaction_timestamp timestamp, status string"


@pytest.fixture(scope="module")
def rows():
    rnd, out = Random(7), []
    for i in range(1500):
        customer = "hot" if i % 3 == 0 else f"c{rnd.randrange(20)}"
        # Whole seconds, some of them equal, some exactly on slot and window edges.
        at = START + timedelta(seconds=rnd.choice([rnd.randrange(90000), 300 * rnd.randrange(300), 3600 * rnd.randrange(25)]))
        out.append((f"T{i:05d}", customer, f"b{rnd.randrange(4)}", float(rnd.randrange(1, 9)), at, rnd.choice(["BLOCKED", "APPROVED", "APPROVED"])))
    return out


@pytest.fixture(scope="module")
def tx(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_customer(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    return groups


@pytest.mark.parametrize("slot", [60, 300, 3600])
def test_velocity(tx, rows, slot):
    got = {r.transaction_id: (r.tx_in_window, r.amount_in_window) for r in W.velocity(tx, 3600, slot).collect()}
    assert len(got) == len(rows)
    for group in by_customer(rows).values():
        for r in group:
            inside = [x for x in group if r[4] - timedelta(hours=1) <= x[4] <= r[4]]
            assert got[r[0]] == (len(inside), sum(x[3] for x in inside))


def test_sessions(tx, rows):
    expected = []
    for customer, group in by_customer(rows).items():
        times = sorted(x[4] for x in group)
        start = last = times[0]
        n = 1
        for t in times[1:]:
            if t - last > timedelta(minutes=30):
                expected.append((customer, start, last + timedelta(minutes=30), n))
                start, n = t, 0
            last, n = t, n + 1
        expected.append((customer, start, last + timedelta(minutes=30), n))
    got = [(r.customer_id, r.session_start, r.session_end, r.transactions) for r in W.sessions(tx).collect()]
    assert sorted(got) == sorted(expected)


def test_sessions_agree_with_session_window(tx):
    from bankweave.streaming.flows import customer_sessions

    native = customer_sessions(tx).select("customer_id", "session_start", "session_end", "transactions", "amount")
    ours = W.sessions(tx).select(*native.columns)
    assert sorted(map(tuple, native.collect())) == sorted(map(tuple, ours.collect()))


@pytest.mark.parametrize("salts,slot", [(1, 86400 * 365), (4, 3600), (8, 600)])
def test_asof(spark, tx, rows, salts, slot):
    rnd = Random(3)
    ticks = [(rnd.choice(["hot", "c1", "c2"]), START + timedelta(seconds=600 * rnd.randrange(150)), float(i)) for i in range(60)]
    got = asof_last(tx, spark.createDataFrame(ticks, "customer_id string, at timestamp, v double"), "customer_id",
                    "transaction_timestamp", "at", "v", "transaction_id", slot, salts)
    result = {r.transaction_id: r.v for r in got.collect()}
    assert len(result) == len(rows)
    for r in rows:
        seen = [(t[1], t[2]) for t in ticks if t[0] == r[1] and t[1] <= r[4]]
        assert result[r[0]] == (max(seen)[1] if seen else None)


def test_percent_rank(spark):
    rnd = Random(5)
    data = [(i, "hot" if i % 3 else f"g{rnd.randrange(3)}", rnd.choice([0.0, -3.5, rnd.uniform(-1e6, 1e6), rnd.lognormvariate(6, 2)])) for i in range(900)]
    data.append((-1, "single", 4.0))
    df = spark.createDataFrame(data, "id int, g string, v double")
    got = {r.id: r.p for r in percent_rank(df, ["g"], "v", "p").collect()}
    assert len(got) == len(data)
    for i, g, v in data:
        peers = [x[2] for x in data if x[1] == g]
        lower = sum(p < v for p in peers)
        assert got[i] == (lower / (len(peers) - 1) if len(peers) > 1 else 0.0)


def test_latest(tx, rows):
    got = {r.customer_id: r.transaction_id for r in latest_by(tx, ["customer_id"], ["transaction_timestamp", "transaction_id"]).collect()}
    assert got == {c: max(g, key=lambda r: (r[4], r[0]))[0] for c, g in by_customer(rows).items()}


def test_follow_ups(tx, rows):
    got = {r.transaction_id for r in J.follow_ups(tx).collect()}
    expected = {
        r[0] for g in by_customer(rows).values() for r in g
        if any(x[5] == "BLOCKED" and x[2] != r[2] and x[4] <= r[4] <= x[4] + timedelta(hours=1) for x in g)}
    assert got == expected and got


def test_cross_bank_fraud(tx, rows):
    got = {(r.customer_id, r.flagged_bank): (r.blocked_at, r.blocked_elsewhere) for r in J.cross_bank_fraud(tx).collect()}
    expected = {}
    for c, g in by_customer(rows).items():
        for bank in {x[2] for x in g}:
            others = [x[2] for x in g if x[5] == "BLOCKED" and x[2] != bank]
            if others:
                expected[(c, bank)] = (",".join(sorted(set(others))), len(others))
    assert got == expected


def test_detection_rate_counts_each_suspect_once(tx):
    row = J.cross_bank_detection(tx).first()
    assert 0 < row.flagged_elsewhere <= row.multi_bank_suspects <= tx.select("customer_id").distinct().count()


def test_top_suspects_keeps_n_per_bank(tx):
    counts = {r.bank_entity: r.c for r in W.top_suspects(tx.withColumn("fraud_score", F.lit(0.5)), 2).groupBy("bank_entity").agg(F.count("*").alias("c")).collect()}
    assert counts == {f"b{i}": 2 for i in range(4)}


def test_rates_of_a_busy_country(spark):
    """One country with a third of the rows and thousands of rates, against a search row by row."""
    import bisect
    import random
    from datetime import date, timedelta

    from bankweave.operators import joins

    rng = random.Random(31)
    start = date(2000, 1, 1)
    rates = [(f"R{i}", "HOT" if i % 2 else f"C{i % 7}", rng.choice(["A", "B"]), i / 1000, start + timedelta(days=i)) for i in range(4000)]
    facts = [(i, "HOT" if i % 3 == 0 else rng.choice(["C0", "C2", "NONE", None]), start + timedelta(days=rng.randint(-5, 4100)) if i % 50 else None) for i in range(6000)]
    r = spark.createDataFrame(rates, "rate_id string, country_code string, rate_type string, rate_value double, effective_date date")
    f = spark.createDataFrame(facts, "id int, country_code string, date date")
    by = {}
    for _, c, kind, value, day in rates:
        by.setdefault((c, kind), []).append((day, value))
    want = []
    for i, c, day in facts:
        own = []
        for kind in ("A", "B"):
            held = by.get((c, kind), [])
            at = bisect.bisect_right(held, (day, float("inf"))) if day else 0
            if at:
                own.append((i, kind, held[at - 1][1], held[at - 1][0]))
        want += own or [(i, None, None, None)]
    got = joins.rates_on(f, r).select("id", "rate_type", "rate_value", "effective_date")
    key = lambda t: tuple(map(str, t))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_velocity_keeps_all_decimals(spark):
    from bankweave.operators import windows

    rows = [("c", f"2024-01-01 10:{m:02d}:00", 23.123456) for m in (0, 10, 20)] + [("c", "2024-01-01 12:00:00", 0.000000001)]
    tx = spark.createDataFrame(rows, "customer_id string, t string, amount double").selectExpr("customer_id", "CAST(t AS TIMESTAMP) AS transaction_timestamp", "amount")
    got = [r["amount_in_window"] for r in windows.velocity(tx).orderBy("transaction_timestamp").collect()]
    assert got == [23.123456, 46.246912, 69.370368, 0.000000001]


def test_rows_of_one_large_row_group_are_dealt_out(spark):
    from bankweave.operators import scale

    rows = spark.range(0, 4000, 1, 1).select((F.col("id") % 1000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("v"))
    dealt = scale.spread(rows, 500)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 700 and dealt.exceptAll(rows).count() == rows.exceptAll(dealt).count() == 0
    assert scale.spread(rows, 4000) is rows and scale.spread(rows.limit(0), 500).count() == 0
