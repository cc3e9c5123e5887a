"""Membership index: which files of a table may hold an id, without reading them.

Beside a table lies one Bloom filter per data file, cut into bitmaps of 4,096 bytes.  An id falls into one bitmap of a filter
and sets ``HASHES`` of its bits.  Data files never change once written, so a filter holds for as long as its file is there; files
that other writers have added since are indexed before an index is asked.  A file without the id is taken for one
that holds it once in some 10^8 times, so a batch of a million new ids finds nearly no file to read.
"""

from __future__ import annotations

import math
import re
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankweave.session import data_sizes, delete_path

BITMAP = 32_768  # bits of a bitmap
HASHES = 12
PER_ID = 48  # bits an id
LIST = 512
SLOTS = 16  # an id is asked for in one of at least so many slots, so that small filters do not meet in one task
_FILE = r"((?:[^/=]+=[^/]*/)*[^/]+)$"
_CELLS = "file string, bitmaps bigint, bitmap bigint, bits binary"


def index_path(table: str, key: str) -> str:
    return f"{table.rstrip('/')}_index/{key}"


def file_name() -> Column:
    """Name below its table of the file that a row is read from."""
    return F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), _FILE, 1)


def _month(file: Column) -> Column:
    """First folder of a file's name without the day, by which filters are kept together."""
    return F.when(file.contains("/"), F.regexp_replace(F.substring_index(file, "/", 1), "-[0-9]+$", "")).otherwise("none")


def _bits(key: str) -> tuple[Column, Column]:
    """Hash that chooses the bitmap, and the bits that an id sets there."""
    first, second = F.xxhash64(F.lit("bitmap"), key), F.xxhash64(F.lit("bits"), key)
    # Three numbers make the row of places: with two, ids that share all their places would be too many.
    a, b, c = (F.pmod(F.shiftrightunsigned(second, 15 * k), F.lit(BITMAP)) for k in range(3))
    places = F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: ((a + i * (b + i * c)) % BITMAP).cast("int"))
    return first, places


def _holds(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, place % 8) == 1


def filters(rows: DataFrame, key: str) -> DataFrame:
    """``file``, ``bitmaps`` (a power of two, by the number of ids), ``bitmap`` and ``bits`` for rows with a column ``file``.

    Rows without id belong to no filter; repeated ids set the same bits.
    """
    known = rows.filter(F.col(key).isNotNull()).select("file", key)
    exact = F.greatest(F.lit(1.0), F.count(F.lit(1)) * PER_ID / BITMAP)
    sizes = known.groupBy("file").agg(F.pow(F.lit(2), F.ceil(F.log2(exact))).cast("long").alias("bitmaps"))
    chosen, places = _bits(key)
    spread = known.join(sizes, "file").select("file", "bitmaps", F.pmod(chosen, "bitmaps").alias("bitmap"), F.explode(places).alias("place"))
    return spread.groupBy("file", "bitmaps", "bitmap").agg(F.bitmap_construct_agg("place").alias("bits"))


def refresh(spark: SparkSession, table: str, key: str = "transaction_id") -> list[str]:
    """Index the files that have none yet; of these only the id column is read.  Returns their names.

    A run that was interrupted has written filters for all its files or for none, and the next run adds what is missing.
    """
    files, index = data_sizes(spark, table), index_path(table, key)
    done = {r["file"] for r in _cells(spark, index).filter("bitmaps = 0").select("file").collect()}  # names of files, not rows
    new = sorted(files.keys() - done)
    if new:
        rows = spark.read.schema(f"`{key}` string").parquet(*[f"{table}/{f}" for f in new])
        found = filters(rows.select(file_name().alias("file"), key), key)
        # Every file is told by a row without bitmap, also one whose ids are all null.
        marks = spark.createDataFrame([(f,) for f in new], "file string").selectExpr("file", "0L AS bitmaps", "0L AS bitmap", "CAST(NULL AS BINARY) AS bits")
        rows = found.unionByName(marks).withColumn("month", _month(F.col("file"))).hint("rebalance", F.col("month"))
        rows.write.mode("append").partitionBy("month").parquet(index)
    return new


def _cells(spark: SparkSession, index: str) -> DataFrame:
    if not data_sizes(spark, index):
        return spark.createDataFrame([], f"{_CELLS}, month string")
    return spark.read.schema(f"{_CELLS}, month string").option("basePath", index).parquet(index)


def may_hold(spark: SparkSession, table: str, ids: DataFrame, key: str = "transaction_id") -> list[str]:
    """Files of the table whose filter lets one of the ids through.  Reads filters alone; ``ids`` has the column ``key``."""
    files = data_sizes(spark, table)
    cells = _cells(spark, index_path(table, key)).filter("bitmaps > 0")
    sizes = [r["bitmaps"] for r in cells.select("bitmaps").distinct().collect()]  # powers of two: some dozens at most
    if not sizes or not files:
        return []
    chosen, places = _bits(key)
    slots = F.greatest(F.lit(SLOTS).cast("long"), "bitmaps")
    ids = ids.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key)).distinct().select(chosen.alias("_h"), places.alias("_places"))
    # About LIST ids of a slot are asked for together, so a bitmap is handed on once for as many.
    lists = F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(ids.count()) / (slots * LIST)))
    asked = (
        ids.withColumn("bitmaps", F.explode(F.array(*[F.lit(s).cast("long") for s in sorted(sizes)]))).withColumn("_slot", F.pmod("_h", slots))
        .groupBy("bitmaps", "_slot", F.pmod(F.xxhash64("_places"), lists).alias("_list")).agg(F.collect_list("_places").alias("_asked")))
    # A small filter's bitmaps are offered to every slot that leads to them.  They are dealt out first: an index of few files would
    # otherwise be asked by as few tasks.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    offered = cells.repartition(tasks, "file", "bitmaps", "bitmap").withColumn("_slot", F.explode(F.sequence(F.col("bitmap"), slots - 1, F.col("bitmaps")))).select("file", "bitmaps", "_slot", "bits")
    met = asked.join(offered, ["bitmaps", "_slot"]).filter(F.exists("_asked", lambda places: F.forall(places, lambda p: _holds(F.col("bits"), p))))
    hit = {r["file"] for r in met.select("file").distinct().collect()}  # names of files, not rows
    return sorted(f"{table}/{f}" for f in hit & files.keys())


def held(spark: SparkSession, table: str, ids: DataFrame, key: str = "transaction_id") -> DataFrame:
    """The ids of ``ids`` that may be in the table: the id column of the files whose filter hits, for an exact join."""
    refresh(spark, table, key)
    hits = may_hold(spark, table, ids, key)
    kind = ids.schema[key].dataType
    if not hits:
        return ids.select(key).limit(0)
    return spark.read.schema(f"`{key}` string").parquet(*hits).select(F.col(key).cast(kind))


def forget(spark: SparkSession, table: str, days: set[str]) -> None:
    """Drop the filters of the months that day folders lie in, of every key; the next question builds those of files still there anew."""
    months = {re.sub("-[0-9]+$", "", day) for day in days}
    for key in {name.partition("/")[0] for name in data_sizes(spark, index_path(table, ""))}:
        for month in months:
            delete_path(spark, f"{index_path(table, key)}/month={quote(month, safe='-_.')}")


def false_hits(ids: int, files: int) -> float:
    """Files that a batch of new ids is expected to hit for nothing."""
    share = (1 - math.exp(-HASHES / PER_ID)) ** HASHES
    return files * (1 - (1 - share) ** ids)
