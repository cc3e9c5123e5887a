"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that ends a word, and a word.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def bound_batches(spark: SparkSession, rows: int = 2000, size: int = 16 << 20) -> None:
    """Bound what one Arrow batch holds, by rows and bytes, so that long texts do not pile up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def frequent(docs: DataFrame, column: str, most: int) -> list[tuple[str, int]]:
    """The ``most`` most frequent values of a column, and their counts; of ties the first by name."""
    counts = docs.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).filter(F.col("value").isNotNull())
    return [(r["value"], r["n"]) for r in counts.orderBy(F.desc("n"), "value").limit(most).collect()]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Runs of rows whose texts sum to about ``most`` bytes (one row at least), each with its texts as UTF-8 bytes or None."""
    for batch in batches:
        texts = batch.column(column)
        if not pa.types.is_binary(texts.type) and not pa.types.is_large_binary(texts.type):
            texts = texts.cast(pa.large_binary())
        start, size = 0, 0
        rows = texts.to_pylist()
        for i, value in enumerate(rows):
            size += len(value or b"") + 64
            if size >= most:
                yield batch.slice(start, i + 1 - start), rows[start : i + 1]
                start, size = i + 1, 0
        if start < len(rows):
            yield batch.slice(start), rows[start:]
