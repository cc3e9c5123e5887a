"""Toxicity: features and updates against a plain version, and held-out accuracy."""

import math
import random
import zlib

import numpy as np
import pytest

from bankweave.llm import queries, toxicity
from bankweave.llm.common import read

DOCS, LABELS = "doc_id long, text string, score string, label string", "doc_id long, toxic int, text string"
MILD = "the house river stone garden winter morning paper window table walk bread".split()
HARSH = "blorg snarf grumph".split()


def made(n, seed, harsh=0.3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = rng.choices(MILD, k=rng.randint(3, 60))
        bad = rng.random() < harsh
        for _ in range(rng.randint(1, 3) if bad else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(HARSH))
        out.append((i, " ".join(words), int(bad)))
    return out


def frames(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], DOCS), spark.createDataFrame([(i, y, "z") for i, _, y in rows], LABELS)


def features_by_hand(text):
    """Distinct features, spelled out."""
    words = [w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]
    return {(w,) for w in words} | {(words[i], words[i + g], g) for g in (1, 2, 3) for i in range(len(words) - g)}


def test_features_against_loops():
    texts = ["One two, three-four FIVE", "", None, "a", "a b", "a_b c", "x x x x", "é Ü ß 42nd", "w " * 3000]
    rows = [set() for _ in texts]
    for row, feature in toxicity.features(toxicity.WordHashes(), [t and t.encode() for t in texts]):
        for r, f in zip(row, feature):
            rows[r].add(int(f))
    assert [len(r) for r in rows] == [len(features_by_hand(t)) for t in texts]
    alone = [set(np.concatenate([f for _, f in toxicity.features(toxicity.WordHashes(), [t and t.encode()])]).tolist()) for t in texts]
    assert alone == rows


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(random.Random(3).choices(MILD, k=500))
    whole = toxicity.WordHashes().of(text)
    monkeypatch.setattr(toxicity, "_SEGMENT", 7)
    assert (toxicity.WordHashes().of(text) == whole).all() and len(whole) == 500


def test_updates_against_single_coordinates():
    rng = random.Random(4)
    learner = toxicity.Learner(0.5, 1.0, 0.3, 0.1)
    z, n = {}, {}

    def weight(i, l1=0.3, l2=0.1):
        v = z.get(i, 0.0)
        if abs(v) <= l1:
            return 0.0
        return -(v - math.copysign(l1, v)) / ((1.0 + math.sqrt(n.get(i, 0.0))) / 0.5 + l2)

    for _ in range(200):
        at, y = sorted(rng.sample(range(30), rng.randint(0, 8))), rng.randint(0, 1)
        learner.learn(np.array(at, np.int64), y)
        own = {i: weight(i) for i in at} | {"bias": weight("bias", 0.0, 0.0)}
        g = 1 / (1 + math.exp(-sum(own.values()))) - y
        for i, w in own.items():
            rate = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / 0.5
            z[i], n[i] = z.get(i, 0.0) + g - rate * w, n.get(i, 0.0) + g * g
    assert np.allclose(learner.weights(np.arange(30)), [weight(i) for i in range(30)])
    assert math.isclose(learner.bias(), weight("bias", 0.0, 0.0))


def test_scores_against_the_sum_of_weights(spark):
    rows = made(400, 1)
    docs, labels = frames(spark, rows)
    model = toxicity.fit(docs, labels, l1=2.0)
    got = {r["doc_id"]: r for r in toxicity.predict(docs, model).collect()}
    weight = dict(zip(model.indices.tolist(), model.weights))
    for i, text, y in rows:
        own = {int(f) for _, feature in toxicity.features(toxicity.WordHashes(), [text.encode()]) for f in feature}
        p = 1 / (1 + math.exp(-(model.bias + sum(weight.get(f, 0.0) for f in own))))
        assert math.isclose(got[i]["score"], p, rel_tol=1e-9) and got[i]["predicted"] == (got[i]["score"] >= 0.3)
    met = {int(f) for _, feature in toxicity.features(toxicity.WordHashes(), [t.encode() for _, t, _ in rows]) for f in feature}
    assert 0 < len(model.indices) < len(met) / 2 and set(weight) <= met
    other = made(200, 2)
    right = toxicity.predict(frames(spark, other)[0], model).collect()
    assert sum(r["predicted"] == y for r, (_, _, y) in zip(sorted(right), sorted(other))) >= 190
    again = toxicity.fit(docs.repartition(5), labels.repartition(3), l1=2.0)
    assert (again.indices == model.indices).all() and (again.weights == model.weights).all()


def test_nulls_repeats_and_empty_tables(spark):
    rows = made(200, 5)
    docs, labels = frames(spark, rows)
    odd = spark.createDataFrame([(None, "blorg", "", ""), (900, None, "", ""), (901, "", "", ""), (902, "...", "", ""), (902, "...", "", "")], DOCS)
    marks = spark.createDataFrame([(None, 1, ""), (0, None, ""), (1, 7, ""), (900, 1, ""), (5, 0, ""), (5, 1, ""), (12345, 1, "")], LABELS)
    model = toxicity.fit(docs.union(odd).union(docs.limit(1)), labels.union(marks), l1=2.0)
    got = toxicity.predict(odd, model).collect()
    bias = 1 / (1 + math.exp(-model.bias))
    assert len(got) == 5 and all(math.isclose(r["score"], bias) for r in got if r["doc_id"] is not None)
    assert odd.columns == ["doc_id", "text", "score", "label"] and set(got[0].asDict()) == {"doc_id", "text", "label", "score", "predicted"}
    for d, m in ((docs, labels.limit(0)), (docs.limit(0), labels), (docs.limit(0), labels.limit(0))):
        nothing = toxicity.fit(d, m)
        assert not nothing.learned and {(r["score"], r["predicted"]) for r in toxicity.predict(docs, nothing).collect()} == {(0.0, 0)}
    assert toxicity.predict(docs.limit(0), model).count() == 0


def test_sample_is_bounded_and_counts_ids_once(spark):
    rows = made(3000, 6) + [(7, "blorg " * 5, 0)] * 500
    docs, labels = frames(spark, rows)
    got = toxicity.sample(docs, labels, None, 600, "doc_id", "text", "toxic").collect()
    assert 500 < len(got) < 700 and len({r["id"] for r in got}) == len(got)
    assert toxicity.sample(docs, labels, None, 10_000, "doc_id", "text", "toxic").count() == 3000


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in read(spark, sf, "labels").collect()}
    got = [r for r in queries.queries()["op12_toxicity"](spark, sf).collect()]
    assert len(got) == read(spark, sf, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [(r["score"], r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    positive, negative = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    auc = sum((p > n) + (p == n) / 2 for p in positive for n in negative) / len(positive) / len(negative)
    recall = sum(p for _, p, y in held if y) / len(positive)
    precision = sum(y for _, p, y in held if p) / max(1, sum(p for _, p, _ in held))
    print(auc, recall, precision)
    assert auc > 0.95 and recall > 0.8 and precision > 0.95


@pytest.mark.parametrize("column", ["score", "predicted"])
def test_added_columns_replace_others(spark, column):
    docs = spark.createDataFrame([(1, "a b", "old")], f"doc_id long, text string, {column} string")
    assert dict(toxicity.predict(docs, toxicity.Model(np.empty(0, np.int64), np.empty(0), 0.0, False)).dtypes)[column] != "string"
