"""Care for the files of a table: merging small ones, and moving old days to a cold tier.

Both write their result aside first and note what they are about to do; a run that was killed at any step is finished or
undone by the next one.  Reading a table between two steps of a swap may meet a day twice or not at all, so both belong into a
quiet hour, like erasure.
"""

from __future__ import annotations

import json
import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankweave.operators.idindex import file_name
from bankweave.operators.tables import CLUSTER, COLD_DAYS, NO_VALUE, PARTS, _as_date
from bankweave.session import data_sizes, delete_path, move_path, partition_values, path_exists, read_text, stage, write_text

TARGET = 128 << 20
MERGED = "merged"


# Compaction.

def first_fit_decreasing(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Bins of at most ``target``: each item, largest first, goes to the first bin with room.  An item over the target is a bin of its own."""
    bins: list[list[str]] = []
    room: list[int] = []
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        at = next((i for i, left in enumerate(room) if left >= sizes[name]), None)
        if at is None:
            bins.append([])
            room.append(target)
            at = len(bins) - 1
        bins[at].append(name)
        room[at] -= sizes[name]
    return bins


def small_files(sizes: dict[str, int], target: int, skip_loads: tuple[str, ...] = ()) -> dict[str, dict[str, int]]:
    """Files of at most half the target, by day folder; loads that may still be repeated are left alone."""
    days: dict[str, dict[str, int]] = {}
    for name, size in sizes.items():
        day, _, rest = name.partition("/")
        if "/" in rest and size <= target // 2 and rest.partition("/")[0].partition("=")[2] not in skip_loads:
            days.setdefault(day, {})[name] = size
    return days


def plan_compaction(sizes: dict[str, int], target: int, run: str, skip_loads: tuple[str, ...] = ()) -> dict[str, list[str]]:
    """Folder of each merged file, and the files that go into it.  Bins with a single file are no gain and are left out."""
    plan = {}
    for day, files in sorted(small_files(sizes, target, skip_loads).items()):
        for k, names in enumerate(first_fit_decreasing(files, target)):
            if len(names) > 1:
                plan[f"{day}/{PARTS[1]}={MERGED}-{run}-{k}"] = names
    return plan


def compact(spark: SparkSession, table: str, target: int = TARGET, skip_loads: tuple[str, ...] = (), stop_after: str | None = None) -> dict[str, list[str]]:
    """Merge the small files of each day of a transaction table into files of about ``target`` bytes; returns the plan.

    Rows keep all columns but the load, which becomes that of the merged file, and are clustered as before.  A load in
    ``skip_loads``, say a stream's last batch, may be repeated later and is not touched.  After a run a day has at most one merged
    file under half the target, besides those of skipped loads.  ``stop_after`` ends a run early, for tests.
    """
    finish_compaction(spark, table)
    aside, run = f"{table}_compact", uuid.uuid4().hex[:8]
    plan = plan_compaction(data_sizes(spark, table), target, run, skip_loads)
    if not plan:
        return {}
    # Names of files and their folders, as many as there are small files.
    bins = stage(spark.createDataFrame([(n, folder.partition("/")[2].partition("=")[2]) for folder, names in plan.items() for n in names], "_file string, _bin string"), "bins")
    schema = spark.read.parquet(table).schema
    rows = spark.read.schema(schema).option("basePath", table).parquet(*[f"{table}/{n}" for names in plan.values() for n in names])
    rows = rows.withColumn("_file", file_name()).join(bins, "_file").drop("_file", PARTS[1]).withColumnRenamed("_bin", PARTS[1])
    out = rows.repartition(len(plan), *PARTS).sortWithinPartitions(*PARTS, *[c for c in CLUSTER if c in rows.columns])
    out.write.mode("overwrite").partitionBy(*PARTS).parquet(f"{aside}/out")
    if stop_after == "write":
        return plan
    write_text(spark, f"{aside}/plan.json", json.dumps(plan))
    if stop_after == "plan":
        return plan
    finish_compaction(spark, table, stop_after)
    return plan


def finish_compaction(spark: SparkSession, table: str, stop_after: str | None = None) -> None:
    """Swap in what a run has written: with a plan it goes on from where it stopped, without one it is dropped."""
    aside = f"{table}_compact"
    noted = read_text(spark, f"{aside}/plan.json")
    if noted is not None:
        for folder, names in json.loads(noted).items():
            if path_exists(spark, f"{aside}/out/{folder}"):
                delete_path(spark, f"{table}/{folder}")
                move_path(spark, f"{aside}/out/{folder}", f"{table}/{folder}")
            if stop_after == "move":
                return
            for name in names:
                delete_path(spark, f"{table}/{name}")
            for load in {n.rpartition("/")[0] for n in names}:
                if not data_sizes(spark, f"{table}/{load}"):
                    delete_path(spark, f"{table}/{load}")
            if stop_after == "delete":
                return
    delete_path(spark, aside)


# Cold tier.

def move_cold(spark: SparkSession, hot: str, cold: str, as_of, days: int = COLD_DAYS, level: int = 9, stop_after: str | None = None) -> list[str]:
    """Move whole days older than ``days`` to the cold path, compressed harder; returns the days moved.

    Rows that came to the hot path for a day that had been moved join it.  Undated rows have no age and stay.
    All days are written aside by one job; then each is noted, put in place, and its files leave the hot path.
    """
    edge = _as_date(as_of) - timedelta(days=days)
    finish_moves(spark, hot, cold)
    files: dict[str, list[str]] = {d: [] for d in partition_values(spark, hot, PARTS[0]) if d != NO_VALUE and d < edge.isoformat()}
    if not files:
        return []
    for name in data_sizes(spark, hot):
        day = name.partition("/")[0].partition("=")[2]
        if day in files:
            files[day].append(name)
    old = sorted(d for d in files if files[d])
    if old:
        schema = spark.read.parquet(hot).schema
        rows = spark.read.schema(schema).option("basePath", hot).parquet(*[f"{hot}/{n}" for d in old for n in files[d]])
        again = sorted(set(old) & set(partition_values(spark, cold, PARTS[0])))
        if again:
            rows = rows.unionByName(spark.read.schema(schema).option("basePath", cold).parquet(*[f"{cold}/{PARTS[0]}={d}" for d in again]))
        out = rows.hint("rebalance", *PARTS).sortWithinPartitions(*PARTS, *[c for c in CLUSTER if c in rows.columns])
        writer = out.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level))
        writer.partitionBy(*PARTS).parquet(f"{cold}_moving")
        if stop_after == "write":
            return old
    for day in old:
        write_text(spark, f"{cold}_moving/{day}.json", json.dumps(files[day]))
        if stop_after == "note":
            return old
        _finish_day(spark, hot, cold, day, stop_after)
        if stop_after:
            return old
    for day in files.keys() - set(old):  # folders without files
        delete_path(spark, f"{hot}/{PARTS[0]}={day}")
    delete_path(spark, f"{cold}_moving")
    return old


def _finish_day(spark: SparkSession, hot: str, cold: str, day: str, stop_after: str | None = None) -> None:
    folder, note = f"{PARTS[0]}={day}", f"{cold}_moving/{day}.json"
    if path_exists(spark, f"{cold}_moving/{folder}"):
        delete_path(spark, f"{cold}/{folder}")
        move_path(spark, f"{cold}_moving/{folder}", f"{cold}/{folder}")
    if stop_after == "move":
        return
    for name in json.loads(read_text(spark, note) or "[]"):
        delete_path(spark, f"{hot}/{name}")
    if not data_sizes(spark, f"{hot}/{folder}"):  # rows that came meanwhile stay for the next run
        delete_path(spark, f"{hot}/{folder}")
    if stop_after == "delete":
        return
    delete_path(spark, note)


def moving(spark: SparkSession, cold: str) -> list[str]:
    """Days noted by a move that has not ended."""
    return sorted(n.removesuffix(".json") for n in data_sizes(spark, f"{cold}_moving") if "/" not in n and n.endswith(".json"))


def finish_moves(spark: SparkSession, hot: str, cold: str) -> None:
    """End the moves that were noted, and drop what was written without a note."""
    for day in moving(spark, cold):
        _finish_day(spark, hot, cold, day)
    delete_path(spark, f"{cold}_moving")


def read_tiers(spark: SparkSession, hot: str, cold: str, as_of, since: str | None = None, days: int = COLD_DAYS) -> DataFrame:
    """The table over both tiers, with its ``tier``; of the days before ``since``, a date, nothing is listed or read.

    Where ``since`` lies within the hot days, the cold path is not touched at all.  A day in the middle of a move is read once.
    """
    edge = (_as_date(as_of) - timedelta(days=days)).isoformat()
    schema = spark.read.parquet(hot).schema
    table = spark.read.schema(schema).parquet(hot)
    recent = table if since is None else table.filter(F.col(PARTS[0]) >= F.lit(since).cast("date"))
    recent = recent.withColumn("tier", F.lit("STANDARD"))
    if since is not None and since >= edge:
        return recent
    put = {d for d in moving(spark, cold) if not path_exists(spark, f"{cold}_moving/{PARTS[0]}={d}")}  # in place, not yet gone from the hot path
    if put:
        left = {n for d in put for n in json.loads(read_text(spark, f"{cold}_moving/{d}.json") or "[]")}
        recent = table.filter(~file_name().isin(sorted(left)))
        recent = (recent if since is None else recent.filter(F.col(PARTS[0]) >= F.lit(since).cast("date"))).withColumn("tier", F.lit("STANDARD"))
    old = [d for d in partition_values(spark, cold, PARTS[0]) if since is None or d >= since]
    if not old:
        return recent
    away = spark.read.schema(schema).option("basePath", cold).parquet(*[f"{cold}/{PARTS[0]}={d}" for d in old])
    return recent.unionByName(away.withColumn("tier", F.lit("COLD")))
