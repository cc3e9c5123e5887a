"""Line dedup: lines that many documents share go from all of them but one.

Lines are exploded with their position, normalised and hashed; distinct documents are counted per hash; lines
over the threshold are dropped and the rest put together again by position.  Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankweave.llm.common import SPACES
from bankweave.session import stage

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """Line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), _UPPER, _UPPER.lower())


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the kept lines as text, and ``n_lines`` (before) and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` distinct documents loses all its
    lines, except in the largest id that holds it.  A null or empty text is one empty line.  Rows that repeat an
    id count as one document, and each is treated by its own text.  Rows without id keep all lines and are not
    counted.  A text that loses all lines becomes empty.  Columns of ``docs`` named like the added ones are
    replaced; all others pass through.

    Keys are compared by two 64-bit hashes.  Counting is a two-level aggregation that combines before each
    shuffle, so a line found everywhere arrives as a few partial counts; the keys over the threshold are stored in
    the shared folder, and the join back to the lines is a plain equi-join, whose hot partitions adaptive execution splits.
    """
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    key = line_key(F.col("__line"))
    long_lines = (
        docs.select(F.col(doc).alias("__doc"), F.xxhash64(text).alias("__text"), F.posexplode(lines).alias("__pos", "__line"))
        .filter(F.col("__doc").isNotNull() & (F.char_length("__line") >= min_chars))
        .select("__doc", "__text", "__pos", key.alias("__key"))
        .filter(F.char_length("__key") >= min_chars)
        .select("__doc", "__text", "__pos", F.xxhash64("__key").alias("__k1"), F.xxhash64(F.lit(1), "__key").alias("__k2"))
    )
    # The shared keys are stored: joined as a table of its own, hot partitions of the lines can be split.
    shared = stage(
        long_lines.select("__k1", "__k2", "__doc").distinct()
        .groupBy("__k1", "__k2").agg(F.count("*").alias("__docs"), F.max("__doc").alias("__keep"))
        .filter(F.col("__docs") >= min_docs).select("__k1", "__k2", "__keep"), "shared-lines",
    )
    drops = (
        long_lines.join(shared, ["__k1", "__k2"]).filter(F.col("__doc") != F.col("__keep"))
        .groupBy("__doc", "__text").agg(F.collect_set("__pos").alias("__drops"))
    )
    others = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    # The split lines are a column below the join, so that the expression above it does not split anew for every line.
    split = docs.select(*others, F.xxhash64(text).alias("__hash"), lines.alias("__lines"))
    on = (split[doc] == drops["__doc"]) & (split["__hash"] == drops["__text"])
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drops")), lambda i: F.col("__lines")[i])
    out = split.join(drops, on, "left").withColumns({
        text: F.array_join(F.when(F.col("__drops").isNull(), F.col("__lines")).otherwise(kept), "\n"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dropped": F.coalesce(F.size("__drops"), F.lit(0)).cast("long"),
    })
    return out.select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
