"""Registered queries around the fraud model.  It is fitted once per session and table set, saved and reloaded."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bankweave.functions.columns import BLOCK_ABOVE
from bankweave.operators import aggregates as A
from bankweave.operators import explain as E
from bankweave.operators import predict as P
from bankweave.operators import tables as K
from bankweave.plans.registry import query, sql
from bankweave.plans.streams import tx_stream
from bankweave.session import new_folder
from bankweave.sources import fixtures as fx
from bankweave.streaming import flows

_FITTED: dict[tuple[str, str], tuple[str, float, dict]] = {}


def fitted(spark, sf) -> tuple[PipelineModel, float, dict]:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        model, auc, counts = P.train_fraud_model(fx.tx_spread(spark, sf))
        _FITTED[key] = (K.save_model(model, new_folder(spark, "lake"), fx.AS_OF), auc, counts)
    path, auc, counts = _FITTED[key]
    return PipelineModel.load(path), auc, counts


def _index(column: str) -> str:
    """Place of each value by falling frequency, ties in order of the value."""
    return f"(SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS i FROM tx GROUP BY {column})"


_INDEXED = ", ".join(f"x_{c}.i AS {name}" for c, name in P.CATEGORIES.items())
_PLACES = {**{name: f"x_{c}.i" for c, name in P.CATEGORIES.items()}, "amount": "amount", "hour": "hour(transaction_timestamp)::DOUBLE",
           "day_of_week": "(dayofweek(d) + 1)::DOUBLE", "day_of_month": "day(d)::DOUBLE"}


@query("m2_m3_feature_vectors", sql("tx", f"""
    SELECT transaction_id, {_INDEXED}, {", ".join(f"{_PLACES[f]} AS f{i}" for i, f in enumerate(P.FEATURES))}
    FROM tx {" ".join(f"JOIN {_index(c)} x_{c} ON tx.{c} = x_{c}.{c}" for c in P.CATEGORIES)}"""))
def m2(spark, sf):
    rows = P.fraud_features(fx.tx(spark, sf))
    out = Pipeline(stages=P.feature_stages()).fit(rows).transform(rows).withColumn("v", vector_to_array("features"))
    return out.select("transaction_id", *P.CATEGORIES.values(), *[F.col("v")[i].alias(f"f{i}") for i in range(len(P.FEATURES))])


@query("m4_m6_k12_fraud_model")
def m4(spark, sf):
    model, auc, counts = fitted(spark, sf)
    return spark.createDataFrame(
        [(len(model.stages), float(auc), counts["train"], counts["test"])], "stages int, auc double, train_rows bigint, test_rows bigint")


@query("m5_split", sql("tx", """
    SELECT transaction_id, CASE WHEN CAST('0x' || substr(md5('42|' || transaction_id), 1, 8) AS BIGINT) % 10 < 8 THEN 'train' ELSE 'test' END AS part
    FROM tx WHERE is_fraud IS NOT NULL"""))
def m5(spark, sf):
    train, test = P.split(P.fraud_features(fx.tx(spark, sf)))
    return train.select("transaction_id", F.lit("train").alias("part")).unionByName(test.select("transaction_id", F.lit("test").alias("part")))


@query("m7_importances")
def m7(spark, sf):
    return P.importances(fitted(spark, sf)[0], fx.tx(spark, sf))


@query("m8_model_scores")
def m8(spark, sf):
    return P.model_scores(fitted(spark, sf)[0], fx.tx_spread(spark, sf)).select("transaction_id", "is_fraud", "fraud_score", "status")


@query("m9_regression_forecast")
def m9(spark, sf):
    return P.regression_forecast(A.daily_liquidity(fx.tx(spark, sf)), "2024-01-30", 7, fx.HOLIDAYS)


@query("r14_model_stream")
def r14(spark, sf):
    scored = flows.model_stream(tx_stream(spark, sf), fitted(spark, sf)[0])
    return flows.run_to_table(scored.select("transaction_id", "is_fraud", "fraud_score", "status"), "model-scores")


@query("m7_contributions", sql("tx", "SELECT transaction_id, TRUE AS adds_up FROM tx"))
def m7_contributions(spark, sf):
    """What the features contribute, and the base, add up to the raw score of every transaction."""
    rows = E.contributions(fitted(spark, sf)[0], fx.tx_spread(spark, sf))
    total = F.aggregate("contributions", F.col("base"), lambda a, c: a + c)
    return rows.select("transaction_id", (F.abs(total - F.col("raw")) < 1e-9).alias("adds_up"))


@query("m7_reasons")
def m7_reasons(spark, sf):
    """The three features that raised the score most, of every transaction that the model blocks."""
    rows = E.contributions(fitted(spark, sf)[0], fx.tx_spread(spark, sf)).withColumn("fraud_score", vector_to_array("probability")[1])
    blocked = E.reasons(rows.filter(F.col("fraud_score") > BLOCK_ABOVE))
    return blocked.select("transaction_id", "fraud_score", F.to_json("reasons").alias("reasons"))
