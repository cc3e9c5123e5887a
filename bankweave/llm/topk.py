"""Exact top-k search by inner product, columnar branch and bound.

Vectors are packed into blocks that store one dimension after the other.  For a block of candidates, partial scores
are accumulated some dimensions at a time; the Cauchy-Schwarz bound on the remaining dimensions (remaining mass of
query and candidate) gives every candidate a highest and lowest possible score, and candidates whose highest lies
under the k-th best known are dropped and the survivors compacted before the next dimensions are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankweave.llm.common import bound_batches

_BLOCKS = "block long, n int, dims int, ids binary, data binary"
_HITS = "query_id long, query_row long, vec_id long, score long"
_LONG = 2**63 - 1


def quantise(column: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null where the vector is null or holds a null or non-finite one."""
    good = F.forall(column, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    # Beyond the range of a long a component takes the nearest long.
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(2**62))), F.lit(-float(2**62)))).cast("long")
    return F.when(good, F.transform(column, whole))


def pack_blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of at most ``rows`` vectors of one length, packed where they lie, dimension by dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        waiting: dict[int, tuple[list, list]] = {}

        def block(dims: int) -> pa.RecordBatch:
            nonlocal number
            ids, parts = waiting.pop(dims)
            data = np.ascontiguousarray(np.array(parts, np.int64).reshape(len(ids), dims).T)
            values = [[number], [len(ids)], [dims], [np.array(ids, np.int64).tobytes()], [data.tobytes()]]
            number += 1
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["block", "n", "dims", "ids", "data"])

        for batch in batches:
            lists = batch.column("vector")
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            for i, vec in enumerate(batch.column("vec_id").to_pylist()):
                part = flat[ends[i] : ends[i + 1]]
                ids, parts = waiting.setdefault(len(part), ([], []))
                ids.append(vec)
                parts.append(part)
                if len(ids) == rows:
                    yield block(len(part))
        for dims in list(waiting):
            yield block(dims)

    return vectors.select("vec_id", "vector").mapInArrow(run, _BLOCKS)


class Block:
    """A block read back: ids, values by dimension, and the mass that remains after each step of dimensions."""

    def __init__(self, n: int, dims: int, ids: bytes, data: bytes, step: int) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.values = np.frombuffer(data, np.int64).reshape(dims, n)
        self.largest = float(np.abs(self.values.astype(np.float64)).max(initial=0))
        self.floats = self.values.astype(np.float64)
        self.starts = list(range(0, dims, step))
        # One part in 10^9 more covers the rounding of the roots.
        squares = self.floats**2
        self.mass = [np.sqrt(squares[s:].sum(axis=0)) * (1 + 1e-9) for s in [*self.starts[1:], dims]]


def best_of_block(query: Block, i: int, block: Block, k: int, step: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of candidates that can be among the ``k`` best of query ``i`` (ties included), given that the
    ``k``-th best so far has score ``floor``."""
    q = query.floats[:, i]
    alive = np.flatnonzero(block.ids != query.ids[i])
    score = np.zeros(len(alive))
    exact = query.largest * block.largest * max(1, len(q)) < 2.0**52
    if not exact:  # beyond doubles: exact integers, all dimensions
        whole = [sum(int(a) * int(b) for a, b in zip(query.values[:, i], block.values[:, c])) for c in alive]
        score = np.array([max(-_LONG - 1, min(_LONG, s)) for s in whole], object)
    else:
        whole_block = len(alive) == len(block.ids)
        for j, s in enumerate(block.starts):
            part = block.floats[s : s + step]
            score = score + q[s : s + step] @ (part if whole_block else part[:, alive])
            slack = query.mass[j][i] * block.mass[j][alive]
            low = floor if floor is not None else -np.inf
            if len(alive) > k:
                low = max(low, np.partition(score - slack, len(alive) - k)[len(alive) - k])
            keep = score + slack + 0.5 >= low
            if not keep.all():
                alive, score, whole_block = alive[keep], score[keep], False
    if len(alive) > k:
        bar = sorted(score)[-k]
        alive, score = alive[score >= bar], score[score >= bar]
        order = np.lexsort((block.ids[alive], -score.astype(np.float64) if exact else [-x for x in score]))[:k] if exact else sorted(
            range(len(alive)), key=lambda c: (-score[c], block.ids[alive[c]]))[:k]
        alive, score = alive[order], score[order]
    return block.ids[alive], score.astype(np.int64)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, step: int = 16, rows: int = 4096, groups: int | None = None,
    vec: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` candidates of ``vectors`` with the highest score for every row of ``queries``, ties to the smaller id.

    Scores are inner products of the quantised components.  Vectors that are null or hold a null or non-finite
    component take no part, and neither do rows without id.  Rows with a query's id are its own and no candidates of it; a candidate
    row that is repeated counts as often as it comes, and each repeated query row gets its own ranks (``query_row``).  Only
    vectors of the query's length are compared.  Other columns are left out; empty tables give no rows.

    Candidates are dealt to ``groups`` groups in blocks of ``rows``, and every block of queries visits each group once, so
    a task holds two blocks at a time.  While a block of queries stays, its k-th best score so far prunes the next blocks.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    groups = groups or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def blocks(df: DataFrame) -> DataFrame:
        vector = df.select(F.col(vec).cast("long").alias("vec_id"), quantise(F.col(embedding), scale).alias("vector"))
        return pack_blocks(vector.filter(F.col("vector").isNotNull() & F.col("vec_id").isNotNull()), rows)

    base = blocks(vectors).withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    asked = blocks(queries).select(*[F.col(c).alias(f"q_{c}") for c in ("block", "n", "dims", "ids", "data")])
    asked = asked.withColumn("q_group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    pairs = asked.join(base, (F.col("q_group") == F.col("group")) & (F.col("q_dims") == F.col("dims"))).drop("q_group", "group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, query, best = None, None, []

        def hits() -> pa.RecordBatch:
            found = [(query.ids[i], held + (i << 20), v, s) for i, (ids, scores) in enumerate(best) for v, s in zip(ids, scores)]
            columns = list(zip(*found)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "query_row", "vec_id", "score"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["q_block"] != held:
                    if query is not None:
                        yield hits()
                    held, query = r["q_block"], Block(r["q_n"], r["q_dims"], r["q_ids"], r["q_data"], step)
                    best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(query.ids)
                block = Block(r["n"], r["dims"], r["ids"], r["data"], step)
                for i in range(len(query.ids)):
                    ids, scores = best[i]
                    new, points = best_of_block(query, i, block, k, step, int(scores[-1]) if len(scores) == k else None)
                    ids, scores = np.concatenate([ids, new]), np.concatenate([scores, points])
                    order = np.lexsort((ids, ~scores))[:k]  # ~s orders like -s and cannot overflow
                    best[i] = ids[order], scores[order]
        if query is not None:
            yield hits()

    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    found = pairs.mapInArrow(run, _HITS).withColumn("rank", rank).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score", "query_row")
