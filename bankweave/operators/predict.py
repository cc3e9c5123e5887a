"""Forecasts, recommendations and the fraud model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankweave.functions import date_lit, decide, is_payday, money, ratio, stable_id, ts_lit
from bankweave.operators.scale import percent_rank
from bankweave.session import stage
from bankweave.sources.generate import mark_days

# Model settings and feature list.
CATEGORIES = {"transaction_type": "type_index", "channel": "channel_index", "bank_entity": "bank_index"}
FEATURES = ["amount", "type_index", "channel_index", "bank_index", "hour", "day_of_week", "day_of_month"]
GBT = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8}
SEED = 42
MODEL_VERSION = "seasonal-1"


def fraud_features(tx: DataFrame) -> DataFrame:
    """Labelled rows with calendar features; numeric gaps become 0."""
    ts = "transaction_timestamp"
    return (
        tx.filter(F.col("is_fraud").isNotNull())
        .withColumn("hour", F.hour(ts)).withColumn("day_of_week", F.dayofweek(ts)).withColumn("day_of_month", F.dayofmonth(ts))
        .na.fill(0.0)
    )


def split(df: DataFrame, key: str = "transaction_id", train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """80/20 split by a digest of the id: the same rows whatever the partitioning."""
    digest = F.md5(F.concat(F.lit(f"{SEED}|"), F.col(key).cast("string")).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10
    return df.filter(bucket < train_tenths), df.filter(bucket >= train_tenths)


def feature_stages() -> list:
    return [
        StringIndexer(inputCols=list(CATEGORIES), outputCols=list(CATEGORIES.values()), handleInvalid="keep"),
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
    ]


def train_fraud_model(tx: DataFrame, **settings) -> tuple[PipelineModel, float, dict[str, int]]:
    """Fit the boosted trees; returns (model, area under ROC on the held-out part, row counts)."""
    # 8 of the columns are needed; the rest of a wide row must not sit in the cache.
    cols = ["transaction_id", "is_fraud", *CATEGORIES, "amount", "hour", "day_of_week", "day_of_month"]
    train, test = split(fraud_features(tx).select(*cols))
    train, test = train.persist(), test.persist()
    try:
        gbt = GBTClassifier(labelCol="is_fraud", featuresCol="features", seed=SEED, **{**GBT, **settings})
        model = Pipeline(stages=[*feature_stages(), gbt]).fit(train)
        auc = BinaryClassificationEvaluator(labelCol="is_fraud", metricName="areaUnderROC").evaluate(model.transform(test))
        return model, auc, {"train": train.count(), "test": test.count()}
    finally:
        train.unpersist()
        test.unpersist()


def importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Weight of each feature in the fitted trees."""
    weights = model.stages[-1].featureImportances.toArray()
    return df.sparkSession.createDataFrame([(f, float(w)) for f, w in zip(FEATURES, weights)], "feature string, importance double")


def model_scores(model: PipelineModel, tx: DataFrame) -> DataFrame:
    """Score by the model, then decide the status by the usual bounds.  Works on a stream."""
    ready = tx.drop("fraud_score", "status")
    for name, expr in {"hour": F.hour, "day_of_week": F.dayofweek, "day_of_month": F.dayofmonth}.items():
        ready = ready.withColumn(name, expr("transaction_timestamp"))
    scored = model.transform(ready).withColumn("fraud_score", vector_to_array("probability")[1])
    return scored.withColumn("status", decide("fraud_score")).select(*[c for c in tx.columns if c not in ("fraud_score", "status")], "fraud_score", "status")


def confusion(tx: DataFrame) -> DataFrame:
    """Label by status counts, with precision and recall of blocking."""
    fraud, blocked = F.col("is_fraud") == 1, F.col("status") == "BLOCKED"
    return tx.filter(F.col("is_fraud").isNotNull()).agg(
        F.count_if(fraud & blocked).alias("true_positive"), F.count_if(~fraud & blocked).alias("false_positive"),
        F.count_if(fraud & ~blocked).alias("false_negative"), F.count_if(~fraud & ~blocked).alias("true_negative"),
    ).withColumn("precision", ratio(F.col("true_positive"), F.col("true_positive") + F.col("false_positive"))).withColumn(
        "recall", ratio(F.col("true_positive"), F.col("true_positive") + F.col("false_negative")))


def label_by_status(tx: DataFrame) -> DataFrame:
    return tx.groupBy("is_fraud", "status").agg(F.count(F.lit(1)).alias("n"))


def _horizon(daily: DataFrame, as_of, days: int, holidays: list[str]) -> DataFrame:
    """One row per bank and coming day."""
    span = F.sequence(F.date_add(date_lit(as_of), 1), F.date_add(date_lit(as_of), days))
    return mark_days(daily.select("bank_entity").distinct().select("bank_entity", F.explode(span).alias("date")), holidays)


def seasonal_forecast(daily: DataFrame, as_of, days: int = 7, holidays: list[str] | None = None) -> DataFrame:
    """Forecast of the next ``days`` days: the bank's mean for that weekday and payday kind,
    or for that weekday when the pair never occurred, with a 95 % band on the net flow."""
    daily = stage(daily, "daily")  # a row per bank and day, read several times
    past = daily.filter(F.col("date") <= date_lit(as_of))

    def level(keys: list[str], tag: str) -> DataFrame:
        n = F.count("net_liquidity")
        return past.groupBy("bank_entity", *keys).agg(
            ratio(F.sum(money("total_inflow")), n).alias(f"in_{tag}"), ratio(F.sum(money("total_outflow")), n).alias(f"out_{tag}"),
            ratio(F.sum(money("net_liquidity")), n).alias(f"net_{tag}"), F.stddev_samp("net_liquidity").alias(f"sd_{tag}"))

    by_pair, by_day = level(["day_of_week", "is_payday"], "p"), level(["day_of_week"], "d")
    rows = _horizon(daily, as_of, days, holidays or []).join(by_pair, ["bank_entity", "day_of_week", "is_payday"], "left").join(
        by_day, ["bank_entity", "day_of_week"], "left")
    net, sd = F.coalesce("net_p", "net_d"), F.coalesce("sd_p", "sd_d", F.lit(0.0))
    return rows.select(
        stable_id("bank_entity", "date", F.lit(MODEL_VERSION)).alias("forecast_id"), "bank_entity", "date",
        F.round(F.coalesce("in_p", "in_d"), 4).alias("predicted_inflow"), F.round(F.coalesce("out_p", "out_d"), 4).alias("predicted_outflow"),
        F.round(net, 4).alias("net_liquidity"), F.round(net - 1.96 * sd, 4).alias("confidence_interval_lower"),
        F.round(net + 1.96 * sd, 4).alias("confidence_interval_upper"), F.lit(MODEL_VERSION).alias("model_version"),
        "is_holiday", "is_payday",
    )


def regression_forecast(daily: DataFrame, as_of, days: int = 7, holidays: list[str] | None = None) -> DataFrame:
    """Boosted-tree form of the net-flow forecast, on the same calendar features."""
    cols = ["day_of_week", "day_of_month", "payday"]
    past = daily.filter(F.col("date") <= date_lit(as_of)).withColumn("payday", F.col("is_payday").cast("int"))
    stages = [
        StringIndexer(inputCol="bank_entity", outputCol="bank_index", handleInvalid="keep"),
        VectorAssembler(inputCols=["bank_index", *cols], outputCol="features"),
        GBTRegressor(labelCol="net_liquidity", featuresCol="features", maxIter=20, maxDepth=4, seed=SEED),
    ]
    model = Pipeline(stages=stages).fit(past)
    ahead = _horizon(daily, as_of, days, holidays or []).withColumn("day_of_month", F.dayofmonth("date")).withColumn(
        "payday", is_payday("date").cast("int"))
    return model.transform(ahead).select(
        "bank_entity", "date", F.col("prediction").alias("net_liquidity"), "is_holiday", "is_payday", F.lit("gbt-1").alias("model_version"))


def customer_features(tx: DataFrame) -> DataFrame:
    """Activity of each customer at each bank."""
    def kind(k: str):
        return F.count_if(F.col("transaction_type") == k)

    return tx.groupBy("bank_entity", "customer_id").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum(money("amount")).cast("double").alias("total_amount"),
        kind("DEPOSIT").alias("deposits"), kind("WITHDRAWAL").alias("withdrawals"),
        kind("PAYMENT").alias("payments"), kind("TRANSFER").alias("transfers"),
        F.count_if(F.col("status") == "BLOCKED").alias("blocked"))


def customer_rank(features: DataFrame, value: str = "total_amount") -> DataFrame:
    """Place of each customer within their bank, from 0 (least) to 1."""
    return percent_rank(features, ["bank_entity"], value, "rank_score")


def recommendations(tx: DataFrame, generated_at) -> DataFrame:
    """Four product scores per customer and bank: the customer's rank, weighted by how they use the bank."""
    f = customer_rank(customer_features(tx))
    n = F.col("transactions")
    weights = {
        "MICRO_CREDIT": ratio(F.col("withdrawals"), n), "SAVINGS": ratio(F.col("deposits"), n),
        "INSURANCE": ratio(F.col("payments"), n), "INVESTMENT": ratio(F.col("transfers"), n),
    }
    pairs = F.array(*[F.struct(F.lit(p).alias("product_type"), w.alias("weight")) for p, w in weights.items()])
    rows = f.select("*", F.inline(pairs))
    eligible = F.when(F.col("blocked") > 0, 0.5).otherwise(1.0)
    return rows.select(
        stable_id("bank_entity", "customer_id", "product_type").alias("product_id"),
        F.concat_ws(" ", F.initcap(F.replace(F.col("product_type"), F.lit("_"), F.lit(" "))), F.lit("offer")).alias("product_name"),
        "customer_id", "bank_entity", F.round(F.col("rank_score") * F.col("weight") * eligible, 6).alias("recommendation_score"),
        "product_type", ts_lit(generated_at).alias("generated_at"),
        F.to_json(F.struct("transactions", "deposits", "withdrawals", "payments", "transfers", "blocked")).alias("features"))
