"""Sinks: partitioned appends, idempotent writes, fan-out, landing, retention and erasure.

Tables are Parquet folders partitioned by date.  Rows are rebalanced on the partition
columns before a write, so that large partitions spread over several tasks and files while
small ones do not shatter.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankweave.functions import run_id, stable_id, ts_lit
from bankweave.operators import idindex
from bankweave.operators.scale import latest_by
from bankweave.session import data_sizes, delete_path, new_folder, partition_values, path_exists

# The column order of the exported history.
EXPORT_COLUMNS = [
    "transaction_id", "bank_entity", "customer_id", "transaction_type", "amount", "currency", "source_account",
    "destination_account", "destination_bank", "channel", "status", "fraud_score", "latitude", "longitude",
    "transaction_timestamp", "branch_id", "is_fraud",
]
CLUSTER = ["bank_entity", "transaction_type", "status"]
# Raw files are deleted, and lake files turn cold, at these ages in days.
RAW_DAYS = 90
COLD_DAYS = 365
# Bytes of a table from which on asking the membership index costs less than reading a column.
INDEX_FROM = 8 << 30


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "append", cluster: list[str] | None = None) -> None:
    """Partitioned Parquet write; ``cluster`` columns are sorted inside each file for row-group skipping.

    An overwrite replaces only the partitions that ``df`` has rows for.
    """
    out = df.hint("rebalance", *[F.col(c) for c in by])
    if cluster:
        out = out.sortWithinPartitions(*by, *cluster)
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


# Transaction tables are partitioned by day first, so that retention and erasure work by folder, and then by
# the load a row came with, so that a repeated load replaces its own folders.
PARTS = ["tx_date", "load"]
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def laid_out(tx: DataFrame, load: str = "batch") -> DataFrame:
    return tx.withColumns({"tx_date": F.to_date("transaction_timestamp"), "load": F.lit(load)})


def write_transactions(tx: DataFrame, path: str, mode: str = "append", load: str = "batch") -> None:
    """Date-partitioned, clustered transaction table; ``mode`` overwrite replaces the days and load that ``tx`` has rows for."""
    write_partitioned(laid_out(tx, load), path, PARTS, mode, [c for c in CLUSTER if c in tx.columns])


def write_kpis(kpis: DataFrame, path: str, mode: str = "append") -> None:
    """KPI table, partitioned by the hour its windows start in."""
    write_partitioned(kpis.withColumn("window_hour", F.date_format("window_start", "yyyy-MM-dd-HH")), path, ["window_hour"], mode)


def liquidity_rows(liquidity: DataFrame, run_at) -> DataFrame:
    """Liquidity table rows.  The day of the flows is kept as ``forecast_date``."""
    return liquidity.select(
        stable_id("bank_entity", "date").alias("forecast_id"), "bank_entity", F.col("date").cast("timestamp").alias("forecast_date"),
        F.col("total_inflow").alias("predicted_inflow"), F.col("total_outflow").alias("predicted_outflow"),
        "net_liquidity", "is_payday", F.lit(run_id(run_at)).alias("run_id"))


def append_liquidity(liquidity: DataFrame, path: str, run_at) -> None:
    """Add liquidity days; a day that is there already, from an overlapping or repeated run, is replaced."""
    rows = liquidity_rows(liquidity, run_at).withColumn("forecast_day", F.to_date("forecast_date"))
    write_partitioned(rows, path, ["forecast_day"], "overwrite")


def append_branches(branches: DataFrame, path: str) -> None:
    """Add branch days; a day that is there already is replaced."""
    write_partitioned(branches.withColumn("metric_day", F.to_date("metric_date")), path, ["metric_day"], "overwrite")


def check_existing(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Fail unless the table exists with the same columns and types: a sink never creates its table."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"table {path} does not exist")
    there = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
    mine = {f.name: f.dataType for f in df.schema.fields}
    if there != mine:
        raise ValueError(f"schema of {path} differs: {sorted(set(there) ^ set(mine)) or 'column types'}")


def create_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Empty table with the schema of ``df``."""
    spark.createDataFrame([], df.schema).write.mode("error").parquet(path)


def one_per_id(df: DataFrame, key: str = "transaction_id", order: list[str] | None = None) -> DataFrame:
    """One row per id, the same one whatever order the copies arrive in."""
    order = order or [c for c in ("processing_timestamp", "transaction_timestamp") if c in df.columns]
    tie = F.xxhash64(*[c for c in df.columns if c != key])
    return latest_by(df.withColumn("_tie", tie), [key], [*order, "_tie"], first=True).drop("_tie")


def append_new(df: DataFrame, path: str, key: str = "transaction_id", load: str = "batch", index_from: int = INDEX_FROM) -> None:
    """Append the rows whose id the table does not hold yet; running it again adds nothing.

    Ids are matched alone, not with their day: a row may be undated, or dated by default when it comes again.
    From ``index_from`` bytes of table on, the membership index tells which files may hold one of the ids, and of those alone the
    id column is read and joined; the id column of a smaller table is read as a whole, which is faster there.
    """
    spark = df.sparkSession
    staged, made = new_folder(spark, "append"), []

    def kept(rows: DataFrame) -> DataFrame:
        made.append(f"{staged}/{len(made)}")
        rows.write.parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    size = sum(data_sizes(spark, path).values())
    if not size:
        fresh = df
    elif size < index_from:
        fresh = df.join(spark.read.schema(df.select(key).schema).parquet(path), key, "left_anti")
    else:
        rows = kept(df)
        fresh = rows.join(idindex.held(spark, path, rows, key), key, "left_anti")
    write_transactions(one_per_id(kept(fresh), key), path, load=load)
    delete_path(spark, staged)


def fan_out(df: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per bank and day; each bank reads its own folders at its own pace."""
    write_partitioned(df.withColumn("dist_date", F.to_date("processing_timestamp")), path, ["bank_entity", "dist_date"], mode)


def subscription(spark: SparkSession, path: str, bank: str) -> DataFrame:
    """What one bank receives.  Only its own folders are listed and read."""
    own = f"{path}/bank_entity={bank}"
    if not path_exists(spark, own):
        return spark.read.parquet(path).filter(F.col("bank_entity") == bank)
    return spark.read.option("basePath", path).parquet(own)


def enqueue(df: DataFrame, path: str, arrived_at) -> None:
    """Bronze append of admitted messages with their routing attributes as columns."""
    rows = df.withColumn("arrival_date", F.to_date(ts_lit(arrived_at)) if isinstance(arrived_at, str) else F.to_date(arrived_at))
    write_partitioned(rows, path, ["arrival_date", "bank_entity"])


def land_daily_close(closes: DataFrame, root: str) -> None:
    """JSON landing, one folder per run and bank."""
    rows = closes.withColumn("execution", F.col("execution_id")).withColumn("bank", F.col("bank_entity"))
    rows.write.mode("append").partitionBy("execution", "bank").json(f"{root}/batch")


def export_csv(df: DataFrame, path: str) -> None:
    """History CSV with header and fixed columns; a column the input lacks stays empty."""
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in EXPORT_COLUMNS]
    df.select(*cols).write.mode("overwrite").option("header", True).option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def save_model(model, root: str, run_at) -> str:
    path = f"{root}/models/fraud_detection/gbt_{run_id(run_at)}"
    model.write().overwrite().save(path)
    return path


def append_quarantine(dead: DataFrame, path: str) -> None:
    rows = dead.withColumn("failed_day", F.to_date("failed_at"))
    write_partitioned(rows, path, ["failed_day"])


def _as_date(moment) -> date:
    return datetime.fromisoformat(str(moment)).date()


def tier(df: DataFrame, as_of, date_col: str = "tx_date", cold_days: int = COLD_DAYS) -> DataFrame:
    edge = F.date_sub(F.lit(str(_as_date(as_of))).cast("date"), cold_days)
    return df.withColumn("tier", F.when(F.col(date_col) < edge, "COLD").otherwise("STANDARD"))


def expire(spark: SparkSession, path: str, as_of, days: int = RAW_DAYS, date_col: str = "tx_date") -> list[str]:
    """Drop the date folders older than ``days``: no row is read or rewritten.  Returns what was dropped.

    Rows without a date have no age and stay.
    """
    edge = _as_date(as_of) - timedelta(days=days)
    old = [d for d in partition_values(spark, path, date_col) if d != NO_VALUE and date.fromisoformat(d) < edge]
    for day in old:
        delete_path(spark, f"{path}/{date_col}={day}")
    return old


def erase_customers(spark: SparkSession, path: str, ids: DataFrame, parts: list[str] | None = None, index_from: int = INDEX_FROM) -> list[str]:
    """Remove every row of the given customers, rewriting only the folders that hold one.

    From ``index_from`` bytes of table on, the membership index tells which files may hold a customer; of those, or of all files of a
    smaller table, the customer column is read to find the folders.
    Survivors are first written to the shared folder and only then swapped in, so an interrupted run can be repeated.
    A folder left without rows is deleted: a dynamic overwrite would keep its old content.  Undated rows lie in
    a folder of their own and are treated alike.  The filters of rewritten days go as well, as they still know the customers.
    """
    key = "customer_id"
    whole = spark.read.parquet(path)
    parts = parts or [c for c in PARTS if c in whole.columns]
    # A partition column that holds nothing but nulls is read without a type.
    schema = whole.withColumns({c: F.col(c).cast("string") for c, kind in whole.dtypes if c in parts and kind == "void"}).schema
    sizes = data_sizes(spark, path)
    if sum(sizes.values()) < index_from:
        files = [f"{path}/{name}" for name in sizes]
    else:
        idindex.refresh(spark, path, key)
        files = idindex.may_hold(spark, path, ids, key)
    if not files:
        return []
    named = spark.read.schema(f"{key} string").parquet(*files).select(idindex.file_name().alias("file"), key)
    hit = named.join(ids.select(key), key, "left_semi").select("file").distinct()
    folders = sorted({r["file"].rpartition("/")[0] for r in hit.collect()})  # names of files, not rows
    if not folders:
        return []
    table = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
    staged = new_folder(spark, "erase")
    keep = table.join(ids.select(key), key, "left_anti")
    clustered = [c for c in CLUSTER if c in table.columns]
    write_partitioned(keep, staged, parts, "overwrite", clustered)
    left = {name.rpartition("/")[0] for name in data_sizes(spark, staged)}
    if left:
        survivors = spark.read.schema(schema).option("basePath", staged).parquet(staged)
        out = survivors.sortWithinPartitions(*parts, *clustered)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    for folder in folders:
        if folder not in left:
            delete_path(spark, f"{path}/{folder}")
    days = {f.partition("/")[0] for f in folders}
    for day in days:
        if not data_sizes(spark, f"{path}/{day}"):
            delete_path(spark, f"{path}/{day}")
    idindex.forget(spark, path, days)
    delete_path(spark, staged)
    return sorted({day.partition("=")[2].replace(NO_VALUE, "None") for day in days})
