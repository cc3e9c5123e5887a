"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankweave.session import delete_path, new_folder


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node that has an edge.

    Each round takes the smallest label among the neighbours, then the label of the label, so long chains shrink by
    jumps.  Rounds are stored in the shared folder and end when no label changes; nothing but a count comes to
    the driver.  Loops and repeated edges do no harm; edges with a null end are left out.
    """
    spark = edges.sparkSession
    folders: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        folders.append(new_folder(spark, "components"))
        df.write.parquet(folders[-1])
        return spark.read.schema(df.schema).parquet(folders[-1])

    pairs = edges.select(F.col(a).alias("node"), F.col(b).alias("next")).filter(F.col("node").isNotNull() & F.col("next").isNotNull())
    both = keep(pairs.union(pairs.select("next", "node")).distinct())
    labels = keep(both.groupBy("node").agg(F.min("next").alias("label")).select("node", F.least("node", "label").alias("label")))
    while True:
        seen = both.join(labels.withColumnsRenamed({"node": "next"}), "next").groupBy("node").agg(F.min("label").alias("near"))
        lower = labels.join(seen, "node").select("node", F.least("label", "near").alias("low"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        after = keep(lower.join(jump, "low", "left").select("node", F.least("low", F.coalesce("far", "low")).alias("label"), "old"))
        done = after.filter(F.col("label") != F.col("old")).limit(1).count() == 0
        labels = after.drop("old")
        for folder in folders[1:-1]:
            delete_path(spark, folder)
        folders[1:-1] = []
        if done:
            delete_path(spark, folders[0])
            return labels
