"""Why the fraud model scored a transaction as it did.

A row's way through a tree changes the expected value at every split; the change belongs to the feature that was asked.  Added up over
all trees, the contributions and the base give the model's raw score.  The trees are read from the saved model once; the model tells
in which leaf of every tree a row ends, and the changes on the way there are added up by NumPy, a batch of rows at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankweave.operators.predict import FEATURES
from bankweave.session import new_folder


def tree_table(spark, model: PipelineModel) -> list[tuple[float, dict[int, tuple]]]:
    """Weight and nodes of every tree: value, left and right child (-1 in a leaf), feature, categories that go left or threshold.

    The size is that of the model, whatever the data.
    """
    folder, forest = new_folder(spark, "trees"), model.stages[-1]
    forest.write().overwrite().save(folder)
    trees: dict[int, dict[int, tuple]] = {}
    for r in spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*").collect():
        split = r["split"]
        trees.setdefault(r["treeID"], {})[r["id"]] = (
            float(r["prediction"]), r["leftChild"], r["rightChild"], split["featureIndex"], [float(x) for x in split["leftCategoriesOrThreshold"]], split["numCategories"])
    return [(float(w), trees[i]) for i, w in enumerate(forest.treeWeights)]


def contributions(model: PipelineModel, tx: DataFrame) -> DataFrame:
    """Rows of ``tx`` with ``base``, ``raw`` (the model's raw score) and ``contributions``, an array in the order of the features."""
    ready = tx
    for name, fn in {"hour": F.hour, "day_of_week": F.dayofweek, "day_of_month": F.dayofmonth}.items():
        ready = ready.withColumn(name, fn("transaction_timestamp"))
    forest = model.stages[-1]
    scored = PipelineModel([*model.stages[:-1], forest.copy({forest.leafCol: "_leaves"})]).transform(ready)
    trees = tree_table(tx.sparkSession, model)
    base = sum(w * nodes[0][0] for w, nodes in trees)
    own = F.arrow_udf(_adder(trees), "array<double>")
    return scored.withColumns({
        "base": F.lit(float(base)), "raw": vector_to_array("rawPrediction")[1], "contributions": own(vector_to_array("_leaves")),
    }).select(*tx.columns, "probability", "base", "raw", "contributions")


def _ways(weight: float, nodes: dict[int, tuple], at: int = 0, way: tuple = ()) -> Iterator[tuple]:
    """Steps (feature, change) from the root to every leaf, leaves from left to right, which is how the model numbers them."""
    value, left, right, feature = nodes[at][:4]
    if left < 0:
        yield way
        return
    for child in (left, right):
        yield from _ways(weight, nodes, child, (*way, (feature, weight * nodes[child][0] - weight * value)))


def _adder(trees: list[tuple[float, dict[int, tuple]]], n: int = len(FEATURES)) -> Callable[[pa.Array], pa.Array]:
    """Function from the leaves of rows, one for each tree, to what every feature contributed.

    Steps are added tree by tree and from the root on, so sums come out the same to the last digit wherever a row is.
    """
    ways = [[*_ways(w, nodes)] for w, nodes in trees]
    first = np.cumsum([0, *map(len, ways)])[:-1]
    depth = max(len(way) for leaves in ways for way in leaves)
    # Shorter ways are filled up with changes of nothing.
    filled = [way + ((0, 0.0),) * (depth - len(way)) for leaves in ways for way in leaves]
    features = np.array([[f for f, _ in way] for way in filled], dtype=np.int64).reshape(len(filled), depth)
    changes = np.array([[c for _, c in way] for way in filled], dtype=np.float64).reshape(len(filled), depth)

    def add(leaves: pa.Array) -> pa.Array:
        ends = leaves.flatten().to_numpy(zero_copy_only=False).reshape(len(leaves), len(first)).astype(np.int64) + first
        sums, row = np.zeros(len(ends) * n), np.arange(len(ends)) * n
        for leaf in ends.T:
            places, steps = features[leaf], changes[leaf]
            for d in range(depth):
                sums[row + places[:, d]] += steps[:, d]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(ends) + 1) * n, pa.int32()), pa.array(sums))

    return add


def reasons(explained: DataFrame, top: int = 3) -> DataFrame:
    """The ``top`` features that raised a row's score most, largest first, ties by name; features that lowered it are none."""
    pairs = F.zip_with(F.array(*[F.lit(f) for f in FEATURES]), "contributions", lambda f, c: F.struct((-c).alias("minus"), f.alias("feature"), c.alias("contribution")))
    best = F.slice(F.array_sort(F.filter(pairs, lambda p: p["contribution"] > 0)), 1, top)
    return explained.withColumn("reasons", F.transform(best, lambda p: F.struct(p["feature"], p["contribution"])))
