"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies.  The documents of a source are put in order,
their expected copies are summed up in front of each, one offset is added, and a document is emitted once for
every integer boundary its interval crosses.  The order is by size class, so that large documents are taken as evenly
as small ones and the words taken stay near the target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankweave.llm.common import n_words
from bankweave.session import stage

WEIGHTS = (5, 2, 1)
SLOT_DIGITS = 3
HOT = 4096  # rows alike in id and size from which on they are dealt to several tasks
PART = "__part"


def source_key(source: str) -> Column:
    """Source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))


def size_class(size: str) -> Column:
    """Eight classes to each doubling of the size, in order of size, by integer operations."""
    bits = F.length(F.bin(F.col(size)))
    return bits * 16 + F.expr(f"shiftright(`{size}`, greatest(length(bin(`{size}`)) - 4, 0))")


def slot(doc: str) -> Column:
    return F.coalesce(F.substring(F.md5(F.col(doc).cast("string")), 1, SLOT_DIGITS), F.lit(""))


def targets(
    sources: DataFrame, share: tuple[int, int] = (3, 2), weights: tuple[int, ...] = WEIGHTS, most: int = 2,
) -> DataFrame:
    """Target words per source; ``sources`` holds ``source`` and ``source_size``.

    Sources in code point order (null last) get ``weights`` in turn and share ``share`` of all words.  A target
    stops at ``most`` times its source's size, and the excess goes to the others by weight.  With caps in order of
    cap / weight, the first source that stays under its cap at the level left for it and all later ones fixes the
    level.  The windows run over one row per source.
    """
    num, den = share
    scale = math.lcm(*weights)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("__n") - 1) % len(weights) + 1).cast("int")).cast("long")
    every = Window.partitionBy()
    order = Window.orderBy("__ratio", "__n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    cap, weight = F.col("__cap"), F.col("weight")
    ranked = (
        sources.withColumn("__n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", w).withColumn("__cap", F.col("source_size") * most)
        .withColumn("__ratio", cap * F.floor(F.lit(scale) / weight))
        .withColumn("__all", F.sum("source_size").over(every)).withColumn("__weights", F.sum("weight").over(every))
        .withColumn("__caps", F.coalesce(F.sum("__cap").over(before), F.lit(0)))
        .withColumn("__gone", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("__free", cap * (F.col("__weights") - F.col("__gone")) * den >= (F.col("__all") * num - F.col("__caps") * den) * weight)
        .withColumn("__level", ((F.col("__all") * num).cast("double") / den - F.col("__caps")) / (F.col("__weights") - F.col("__gone")))
        .withColumn("__level", F.min_by(F.when(F.col("__free"), F.col("__level")), F.when(F.col("__free"), F.struct("__ratio", "__n"))).over(every))
    )
    target = F.when(F.col("__free"), F.col("__level") * weight).otherwise(cap.cast("double"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def mix_sizes(
    sizes: DataFrame, share: tuple[int, int] = (3, 2), weights: tuple[int, ...] = WEIGHTS, most: int = 2, seed: str = "mix",
    doc: str = "doc_id", source: str = "source", size: str = "size", drawn: DataFrame | None = None, hot: int = HOT,
) -> DataFrame:
    """Rows of ``drawn`` (``sizes`` by default) with ``source_size``, ``target`` and ``copies``.

    ``sizes`` holds id, source and size of every row of ``drawn`` and is read several times, so it should be a stored
    table (``parted``).  Rows without id, repeated rows and empty texts are documents like others; a null source is a source of
    its own.  A source without words has target 0 and no copies.  No row gets more than ``most`` copies.  Columns of ``drawn`` named
    like the added ones are replaced.

    Rows of one (source, size class, hash slot) meet in one task, never those of a whole source; slots are prefix-summed
    within a class and classes within a source.  Rows alike in id and size fall into one slot.  If they are more than ``hot``,
    they are ranked by the part of the stored table that they lie in, and the parts' counts are prefix-summed like slots; this
    needs the column that ``parted`` adds.  Targets are found in one task over a row for each source.
    """
    parts = PART in sizes.columns and (drawn is None or PART in drawn.columns)

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"__src": source_key(source), "__class": size_class(size), "__slot": slot(doc)})

    added = ["source_size", "target", "copies"]
    drawn = (sizes if drawn is None else drawn).drop(*added)
    narrow = keyed(sizes.select(doc, source, size, *([PART] if parts else [])))
    in_front = ["__src", "__class", "__slot"]
    like = F.struct(F.col(size).alias("size"), F.col(doc).isNull().alias("last"), F.col(doc).alias("doc"))
    crowd = None
    if parts:
        full = stage(narrow.groupBy(*in_front).agg(F.count("*").alias("__rows")).filter(F.col("__rows") > hot).select(*in_front), "full-slots")
        if full.count():
            alike = narrow.join(full, in_front).groupBy(*in_front, like.alias("__like")).agg(F.count("*").alias("__rows")).filter(F.col("__rows") > hot)
            crowd = stage(alike.groupBy(*in_front).agg(F.array_sort(F.collect_list("__like")).alias("__crowds")), "crowds")

    def segmented(df: DataFrame) -> DataFrame:
        """The rows with their segment of the slot: crowds have odd numbers, what lies between them even ones."""
        if crowd is None:
            return df.withColumns({"__segment": F.lit(0), "__sub": F.lit(0)})
        df = df.join(crowd, in_front, "left").withColumn("__like", like)
        below = F.size(F.filter("__crowds", lambda c: c < F.col("__like")))
        within = F.exists("__crowds", lambda c: c == F.col("__like"))
        segment = F.when(F.col("__crowds").isNull(), 0).otherwise(2 * below + within.cast("int"))
        df = df.withColumn("__segment", segment).drop("__crowds", "__like")
        return df.withColumn("__sub", F.when(F.col("__segment") % 2 == 1, F.col(PART)).otherwise(0))

    place = [*in_front, "__segment", "__sub"]
    slots = segmented(narrow).groupBy(*place).agg(F.count("*").alias("__rows"), F.sum(size).alias("__words"))
    classes = slots.groupBy("__src", "__class").agg(F.sum("__rows").alias("__rows"))
    running = Window.unboundedPreceding
    class_before = F.sum("__rows").over(Window.partitionBy("__src").orderBy("__class").rowsBetween(running, -1))
    slot_before = F.sum("__rows").over(Window.partitionBy("__src", "__class").orderBy("__slot", "__segment", "__sub").rowsBetween(running, -1))
    per_source = (
        slots.groupBy("__src").agg(F.sum("__words").alias("source_size"))
        .withColumn("source", F.when(F.col("__src") != "n", F.expr("substring(__src, 2)")))
    )
    plan = (
        slots.withColumn("__slots", F.coalesce(slot_before, F.lit(0)))
        .join(classes.select("__src", "__class", F.coalesce(class_before, F.lit(0)).alias("__classes")), ["__src", "__class"])
        .join(targets(per_source, share, weights, most).withColumn("__src", source_key("source")).drop("source", "weight"), "__src")
        .select(*place, (F.col("__slots") + F.col("__classes")).alias("__before"), "source_size", "target")
    )
    in_slot = Window.partitionBy(*place).orderBy(size, F.col(doc).asc_nulls_last())
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("__src"))), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = segmented(keyed(drawn)).withColumn("__at", F.row_number().over(in_slot)).join(plan, place)
    rows = rows.withColumns({"__rank": F.col("__at") + F.col("__before"), "__rate": rate, "__offset": offset})
    edge = lambda rank: F.floor(F.col("__offset") + F.col("__rate") * rank)
    copies = F.least(edge(F.col("__rank")) - edge(F.col("__rank") - 1), F.lit(most)).cast("long")
    return rows.withColumn("copies", copies).select(*drawn.columns, *added)


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("size", n_words(text))


def parted(docs: DataFrame) -> DataFrame:
    """``docs`` stored, each row with the number of the part that it was written from."""
    return stage(docs.withColumn(PART, F.spark_partition_id()), "sizes")


def emit(mixed: DataFrame) -> DataFrame:
    """Every row as many times as it has copies."""
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.filter(F.col("copies") > 0).withColumn("__copy", copies).drop("__copy")
