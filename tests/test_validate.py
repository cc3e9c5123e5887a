"""Edge cases of message checks."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from bankweave import schemas as S
from bankweave.functions import decide, hash_score, is_payday, parse_amount, ts_lit
from bankweave.operators import validate as V
from bankweave.sources.files import explode_lots, single_requests

GOOD = {
    "bank_entity": "banco-norte-metropolitano", "customer_id": "CLI-1", "transaction_type": "PAYMENT",
    "amount": 10.5, "currency": "USD", "channel": "APP",
}


def but(**changes):
    message = {**GOOD, **changes}
    return json.dumps({k: v for k, v in message.items() if v is not ...}, ensure_ascii=False)


CASES = [
    (but(), 0), (but(currency=...), 1), (but(currency=..., channel=..., amount=...), 3), (but(bank_entity="x", channel="y"), 2),
    (but(amount=0), 1), (but(amount=-5), 1), (but(amount="12.5"), 0), (but(amount="abc"), 1), (but(amount=None), 1),
    (but(amount={"x": 1}), 1), (but(amount="NaN"), 1), (but(amount="Infinity"), 1), (but(amount=True), 1), (but(bank_entity=["a"]), 1),
    (but(amount="12.5f"), 1), (but(amount="1e3"), 0), (but(amount="1e999"), 1), (but(bank_entity=None), 1), (but(customer_id=None), 0),
    ("{}", 6), ("not json", 1), ("[1]", 1), ("", 1), ('{"amount": NaN}', 1), (but() + " tail", 1),
]


def test_error_counts(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CASES)], "i int, raw string")
    got = {r.i: r.errors for r in V.validate(df).collect()}
    for i, (raw, expected) in enumerate(CASES):
        assert len(got[i]) == expected, (raw, got[i])


def test_malformed_rows_are_told_apart(spark):
    df = spark.createDataFrame([("{}",), ("[1]",), ("x",), (None,)], "raw string")
    flags = {r.raw: r.malformed for r in V.parse(df).collect()}
    assert flags == {"{}": False, "[1]": True, "x": True, None: True}


def test_messages(spark):
    df = spark.createDataFrame([(but(bank_entity="x", amount=-1),), (but(channel=...),)], "raw string")
    errors = [r.errors for r in V.validate(df).collect()]
    assert errors == [[S.MSG_BANK + "x", S.MSG_NOT_POSITIVE], [S.MSG_MISSING + "channel"]]


def test_defaults_and_metadata(spark):
    raw = [but(), but(transaction_id="T1", status="APPROVED", extra="e"), but(transaction_id=None, amount="1e3")]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    rows = V.admit(V.accepted(V.validate(df)), ts_lit("2024-01-31 00:00:00")).collect()
    assert [r.transaction_id for r in rows] == [hashlib.sha256(raw[0].encode()).hexdigest(), "T1", hashlib.sha256(raw[2].encode()).hexdigest()]
    assert {r.status for r in rows} == {"PENDING"}
    assert [r.amount for r in rows] == [10.5, 10.5, 1000.0]
    assert [r.metadata for r in rows] == [None, '{"extra":"e"}', None]
    assert all(str(r.transaction_timestamp) == "2024-01-31 00:00:00" for r in rows)


def test_score_equals_big_integer_arithmetic(spark):
    ids = [f"T{i}" for i in range(300)] + ["", "ñandú", "a" * 1000]
    df = spark.createDataFrame([(i,) for i in ids], "id string").withColumn("s", hash_score("id"))
    for r in df.collect():
        assert r.s == (int(hashlib.md5(r.id.encode()).hexdigest(), 16) % 100) / 100.0


def test_decision_bounds_are_strict(spark):
    df = spark.createDataFrame([(0.85,), (0.86,), (0.7,), (0.71,), (None,)], "s double").select(decide("s").alias("d"))
    assert [r.d for r in df.collect()] == ["PENDING", "BLOCKED", "APPROVED", "PENDING", "PENDING"]


@pytest.mark.parametrize("text,value", [("1", 1.0), (" +.5 ", 0.5), ("5.", 5.0), ("1_000", None), ("1d", None), ("", None), ("-2E-1", -0.2)])
def test_amount_text(spark, text, value):
    assert spark.range(1).select(parse_amount(F.lit(text)).alias("v")).first().v == value


def test_month_end_payday(spark):
    df = spark.sql("select date'2023-02-28' d union all select date'2023-02-15' union all select date'2023-02-27'")
    got = df.select(is_payday("d").alias("a"), is_payday("d", include_last_day=True).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(False, True), (True, True), (False, False)]


def test_lots(spark):
    bodies = [(1, json.dumps({"transactions": [GOOD, {"a": 1}]})), (2, '{"rows": []}'), (3, '{"transactions": []}'), (4, "x")]
    rows = explode_lots(spark.createDataFrame(bodies, "lot int, body string")).collect()
    seen = {(r.lot, r.position, r.lot_error) for r in rows}
    assert seen == {(1, 0, None), (1, 1, None), (2, None, S.MSG_NO_LOT), (3, None, None), (4, None, S.MSG_NO_LOT)}


def test_single_requests(spark):
    rows = single_requests(spark.createDataFrame([("{}",), (but(),), ("null",)], "body string")).collect()
    assert [r.request_error for r in rows] == [S.MSG_EMPTY_BODY, None, S.MSG_EMPTY_BODY]


def test_backoff_and_parking(spark):
    dead = spark.sql("select id, cast(id as int) attempt, timestamp'2024-01-01 00:00:00' failed_at from range(1, 8)")
    rows = {r.id: r for r in V.with_backoff(dead).collect()}
    waits = [(rows[i].next_attempt_at - rows[i].failed_at).total_seconds() for i in range(1, 8)]
    assert waits == [10, 20, 40, 80, 160, 320, 600]
    assert [rows[i].parked for i in range(1, 8)] == [False] * 4 + [True] * 3
    assert V.due(dead, "2024-01-01 00:01:30").count() == 4
