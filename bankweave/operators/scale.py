"""Building blocks that stay exact and bounded per task when one key holds much of the data.

A window over a few wide keys (twelve banks, three currencies, one very busy customer)
would pull a whole key into one task.  Each helper here first shrinks or slices the key:

* ``latest_by``     partial aggregation instead of ``row_number``;
* ``asof_last``     slices a key by time slot and salt, carrying the last value into each slice;
* ``percent_rank``  slices a key by value range and adds the count of all lower slices;
* ``spread``        deals rows out that a few large files would leave to a few tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankweave.functions import epoch_slot


# Rows that a task should have at most where each costs much.
TASK_ROWS = 500_000


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` over so many tasks that each has about ``rows`` rows, if one of its own would have more.

    A row group is read by one task, however large it is, and what follows would stay there.  Rows go by a hash of all their
    columns, so a task that is repeated deals them alike.  Counting them reads the columns that ``df`` is filtered by.
    """
    rows = rows or TASK_ROWS
    n = F.count(F.lit(1)).alias("n")
    most, total = df.groupBy(F.spark_partition_id().alias("task")).agg(n).agg(F.max("n"), F.sum("n")).first()
    return df.repartition(-(-total // rows), *df.columns) if most and most > rows else df


def latest_by(df: DataFrame, keys: list[str], order: list[str], first: bool = False) -> DataFrame:
    """Whole row with the greatest (or least) ``order`` per key, combined map-side before the shuffle."""
    pick = F.min_by if first else F.max_by
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    return df.groupBy(*keys).agg(pick(row, F.struct(*order)).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def asof_last(
    facts: DataFrame, ticks: DataFrame, key: str, fact_ts: str, tick_ts: str, value: str,
    row_id: str, slot_seconds: int = 3600, salts: int = 8,
) -> DataFrame:
    """Add to every fact the ``value`` of the last tick of its key at or before ``fact_ts``.

    Facts of one key are cut into (slot, salt) slices; the few ticks of a slot are copied to
    each of its salts, and the last value of all earlier slots enters each slice as an opening row.
    """
    salt_list = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    ticks = (
        ticks.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(key), F.col(tick_ts).alias("_ts")).agg(F.max(value).alias("_val"))
        .withColumn("_slot", epoch_slot("_ts", slot_seconds))
    )
    facts = facts.withColumn("_slot", epoch_slot(fact_ts, slot_seconds))

    closing = ticks.groupBy(key, "_slot").agg(F.max_by("_val", "_ts").alias("_close"))
    used = facts.select(key, "_slot").distinct().withColumn("_close", F.lit(None).cast(ticks.schema["_val"].dataType))
    per_slot = closing.unionByName(used).groupBy(key, "_slot").agg(F.max("_close").alias("_close"))
    before = Window.partitionBy(key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        per_slot.withColumn("_val", F.last("_close", ignorenulls=True).over(before))
        .filter(F.col("_val").isNotNull())
        .select(key, "_slot", F.lit(None).cast("timestamp").alias("_ts"), F.lit(0).alias("_kind"), "_val")
    )
    marks = (
        opening.unionByName(ticks.withColumn("_kind", F.lit(1)))
        .withColumn("_salt", salt_list)
        .withColumn("_fact", F.lit(None).cast(facts.drop("_slot").schema))
    )
    rows = facts.select(
        F.col(key), "_slot", F.col(fact_ts).alias("_ts"), F.lit(2).alias("_kind"),
        F.lit(None).cast(ticks.schema["_val"].dataType).alias("_val"),
        F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int").alias("_salt"),
        F.struct(*[F.col(c) for c in facts.columns if c != "_slot"]).alias("_fact"),
    )
    upto = (
        Window.partitionBy(key, "_slot", "_salt").orderBy(F.col("_ts").asc_nulls_first(), "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.unionByName(marks)
        .withColumn("_asof", F.last("_val", ignorenulls=True).over(upto))
        .filter(F.col("_kind") == 2)
        .select("_fact.*", F.col("_asof").alias(value))
    )


def value_cell(value: Column, per_e_fold: int = 64) -> Column:
    """Slice number that never decreases as the value grows."""
    up = F.floor(F.ln(F.lit(1.0) + F.abs(value)) * per_e_fold).cast("bigint")
    return F.when(value < 0, -up - 1).otherwise(up)


def percent_rank(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """``percent_rank() over (partition by group order by value)`` without a whole group in one task.

    Equal values are merged first; the running count is taken inside narrow value slices and
    the slice totals, few per group, supply the count of everything below.
    """
    freq = (
        df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_cell", value_cell(F.col(value).cast("double")))
    )
    by_slice = Window.partitionBy(*group).orderBy("_cell")
    cells = (
        freq.groupBy(*group, "_cell").agg(F.sum("_n").alias("_cell_n"))
        .withColumn("_below", F.coalesce(
            F.sum("_cell_n").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_all", F.sum("_cell_n").over(Window.partitionBy(*group)))
        .select(*group, "_cell", "_below", "_all")
    )
    inside = Window.partitionBy(*group, "_cell").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        freq.withColumn("_lower", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(cells.withColumnsRenamed({c: f"_c_{c}" for c in [*group, "_cell"]}), [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in [*group, "_cell"]])
        .select(
            *group, value,
            F.when(F.col("_all") > 1, (F.col("_below") + F.col("_lower")).cast("double") / (F.col("_all") - 1).cast("double"))
            .otherwise(0.0).alias(out),
        )
    )
    # Null groups and values are groups and values like others.
    ranked = ranked.withColumnsRenamed({c: f"_r_{c}" for c in [*group, value]})
    on = F.lit(True)
    for c in [*group, value]:
        on = on & df[c].eqNullSafe(ranked[f"_r_{c}"])
    return df.join(ranked, on).select(*[df[c] for c in df.columns], out)
