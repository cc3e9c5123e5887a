"""Corpus pipeline: from raw documents to packed training sequences.

Every stage is written as Parquet to the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankweave.llm import lines, mixing, ngrams, packing, quality
from bankweave.llm.common import WORD, read
from bankweave.llm.queries import tokenizer_path
from bankweave.session import stage

# No SQL: quality references, MinHash and token ids are not expressible; tests/llm holds a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and resemble a language of the corpus.

    Null, empty and short texts fail.  Rows are judged one by one: repeated rows and null ids fare like others, an empty table stays
    empty, columns other than id, language and text pass through whatever their names.
    """
    rows = packed(docs, "doc_id", "lang", "text")
    return unpacked(quality.judge(rows, quality.fit_references(rows)).filter("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others share with them.

    A null text becomes an empty one.  Repeated rows lose and keep the same lines; documents without id are no
    one's largest.  An empty table stays empty, other columns pass through.
    """
    kept = lines.line_dedup(packed(docs, "doc_id", "text"))
    return unpacked(kept, docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that links hold together.  Documents without words stay.

    A row that repeats a document goes as well: rows are alike by id and text, so any of them may stay.  A null id is an id like others and larger than all.  An empty table stays empty, other columns pass through.
    """
    joined = ngrams.ngram_join(docs.select("doc_id", "text"))
    # A struct holds the id, as it is never null: the join then needs no other order than the aggregation's.
    key = [F.struct(F.col("doc_id").alias("id")).alias("__id"), F.col("__own")]
    kept = joined.filter("first").select("doc_id", F.col("text_hash").alias("__own")).select(*key).distinct()
    rows = packed(docs, "doc_id", "text").withColumn("__own", F.xxhash64("text"))
    words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    # Rows alike are merged before they are shuffled, so none of them is too many for a task.
    once = rows.filter(words).groupBy(*key).agg(F.first(F.struct("doc_id", "text", "__row")).alias("__one"))
    held = once.join(kept, ["__id", "__own"], "left_semi").select("__one.*")
    return unpacked(held.union(rows.filter(~words).select("doc_id", "text", "__row")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    A null source is a source of its own.  Repeated rows and rows without id are documents like others; a document without words is
    taken like the others of its source, unless that has no words at all.  An empty table stays empty, other columns pass through.
    """
    sized = mixing.sized(packed(docs, "doc_id", "source", "text"))
    return unpacked(mixing.emit(mixing.mix_sizes(mixing.parted(sized))), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens.

    Null and empty texts are their end token alone, repeated rows are packed as often as they come, null ids pass through,
    other columns are left out.  An empty table gives no pieces.
    """
    return packing.pack(docs, tokenizer_path())


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns a stage reads, and all others in one, so that none of them meets a name that the stage adds."""
    others = [F.col(c) for c in docs.columns if c not in columns]
    return docs.select(*columns, F.struct(*others, F.lit(True).alias("__any")).alias("__row"))


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c) if c in rows.columns and c not in rows.schema["__row"].dataType.names else F.col("__row")[c].alias(c) for c in docs.columns])


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mix_sources), ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
