"""Model operators: invariants instead of exact values."""

from pyspark.sql import functions as F

from bankweave.operators import predict as P
from bankweave.session import new_folder
from bankweave.operators import tables as K
from bankweave.sources import fixtures as fx
from pyspark.ml import PipelineModel


def test_split_is_stable_and_complete(spark, sf_dir):
    tx = fx.tx(spark, sf_dir)
    train, test = P.split(tx)
    again, _ = P.split(tx.repartition(5))
    assert train.count() + test.count() == tx.count()
    assert train.select("transaction_id").exceptAll(again.select("transaction_id")).count() == 0
    assert 0.7 < train.count() / tx.count() < 0.9


def test_gaps_become_zero_only_in_numbers(spark, sf_dir):
    tx = fx.tx(spark, sf_dir).withColumn("amount", F.lit(None).cast("double")).withColumn("channel", F.lit(None).cast("string"))
    row = P.fraud_features(tx).first()
    assert row.amount == 0.0 and row.channel is None


def test_model_learns_scores_and_reloads(spark, sf_dir):
    tx = fx.tx(spark, sf_dir)
    model, auc, counts = P.train_fraud_model(tx, maxIter=5, maxDepth=3)
    assert auc > 0.9 and counts["train"] > counts["test"] > 0
    path = K.save_model(model, new_folder(spark, "m"), fx.AS_OF)
    assert path.endswith("gbt_20240131_000000")
    unseen = tx.limit(5).withColumn("bank_entity", F.lit("never seen"))
    scored = P.model_scores(PipelineModel.load(path), tx.unionByName(unseen))
    bad = scored.filter(~F.col("fraud_score").between(0, 1) | ~F.col("status").isin("APPROVED", "PENDING", "BLOCKED"))
    assert scored.count() == tx.count() + 5 and bad.count() == 0
    weights = {r.feature: r.importance for r in P.importances(model, tx).collect()}
    assert abs(sum(weights.values()) - 1) < 1e-9 and max(weights, key=weights.get) in ("amount", "channel_index")


def test_regression_forecast_covers_every_bank_and_day(spark, sf_dir):
    from bankweave.operators.aggregates import daily_liquidity

    daily = daily_liquidity(fx.tx(spark, sf_dir))
    rows = P.regression_forecast(daily, "2024-01-30", 3, fx.HOLIDAYS)
    assert rows.count() == 3 * daily.select("bank_entity").distinct().count()


def test_contributions_against_a_walk_by_hand(spark, sf_dir):
    """A small forest walked node by node; the area under the curve by rank sums, from the scores that the walk gives."""
    import math

    from bankweave.operators import explain

    tx = fx.tx(spark, sf_dir)
    model, auc, _ = P.train_fraud_model(tx, maxIter=4, maxDepth=3)
    rows = explain.reasons(explain.contributions(model, tx)).collect()
    features = {r["transaction_id"]: r["features"].toArray() for r in model.transform(P.fraud_features(tx)).select("transaction_id", "features").collect()}
    trees = explain.tree_table(spark, model)
    base = sum(w * nodes[0][0] for w, nodes in trees)
    raw = {}
    for r in rows:
        x, own = features[r["transaction_id"]], [0.0] * len(P.FEATURES)
        for w, nodes in trees:
            at = 0
            while nodes[at][1] >= 0:
                value, left, right, f, split, categories = nodes[at]
                at = left if (x[f] in split if categories >= 0 else x[f] <= split[0]) else right
                own[f] += w * (nodes[at][0] - value)
        assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(own, r["contributions"])) and math.isclose(r["base"], base)
        assert math.isclose(base + sum(own), r["raw"], abs_tol=1e-9)
        want = sorted((-c, f) for f, c in zip(P.FEATURES, own) if c > 0)[:3]
        assert [x["feature"] for x in r["reasons"]] == [f for _, f in want]
        raw[r["transaction_id"]] = base + sum(own)
    test = [(raw[r["transaction_id"]], r["is_fraud"]) for r in P.split(P.fraud_features(tx))[1].select("transaction_id", "is_fraud").collect()]
    good, bad = [s for s, y in test if y], [s for s, y in test if not y]
    by_rank = sum((a > b) + (a == b) / 2 for a in good for b in bad) / len(good) / len(bad)
    assert math.isclose(by_rank, auc, abs_tol=1e-9)


def test_a_row_costs_few_steps_to_explain(spark, sf_dir):
    """No array of nodes beside every row, and no walk in expressions: the model gives the leaves."""
    from bankweave.operators import explain

    tx = fx.tx(spark, sf_dir)
    model, _, _ = P.train_fraud_model(tx, maxIter=2, maxDepth=2)
    rows = explain.contributions(model, tx)
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and "_nodes" not in text and "aggregate(" not in text
    assert rows.columns == [*tx.columns, "probability", "base", "raw", "contributions"]
    assert rows.filter("abs(aggregate(contributions, base, (a, c) -> a + c) - raw) > 1e-9 OR size(contributions) <> 7").count() == 0


def test_training_is_dealt_out_over_tasks(spark, sf_dir, monkeypatch):
    """Rows of one row group, of which a task would have too many."""
    from bankweave.operators import scale

    monkeypatch.setattr(scale, "TASK_ROWS", 100)
    spread = fx.tx_spread(spark, sf_dir)
    tasks = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 200
    assert spread.exceptAll(fx.tx(spark, sf_dir)).count() == 0 and spread.count() == fx.tx(spark, sf_dir).count()
