"""N-gram Jaccard join by MinHash banding.

Documents with equal n-gram sets form a class, of which one document goes on.  Its MinHash values are cut into
bands; documents that agree in a band meet in a bucket, every bucket has its smallest member as leader, and the members of
all buckets of one leader are verified together on their full n-gram sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankweave.llm.common import bound_batches, text_chunks
from bankweave.llm.components import components
from bankweave.session import stage

WORDS = 5
THRESHOLD = (4, 5)  # a similarity of 0.8, as a fraction, so that it is compared exactly
RECALL = 0.9999
BLOCK_DOCS, BLOCK_NGRAMS = 512, 1 << 20
_COLUMNS = 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)


def banding(threshold: float, recall: float = RECALL, most: int = 80) -> tuple[int, int]:
    """Bands and rows: the most rows for which ``most`` hash functions let a pair at the threshold agree in some band with
    probability ``recall``."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, most):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows > most:
            break
        best = bands, rows
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text; a shorter text is one n-gram, one without words has none."""
    split = [t.split() for t in texts]
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for words in split for w in words], np.int64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in known], np.uint64)
    flat = hashes[ids] if len(ids) else np.empty(0, np.uint64)
    grams = np.zeros(max(0, len(flat) - n + 1), np.uint64)
    for i in range(n):
        grams = grams * _ODD + flat[i : len(flat) - n + 1 + i]
    grams = _mix(grams)
    out, at = [], 0
    for words in split:
        if len(words) >= n:
            out.append(np.unique(grams[at : at + len(words) - n + 1]))
        else:
            whole = np.array([len(words)], np.uint64)
            for h in flat[at : at + len(words)]:
                whole = whole * _ODD + h
            out.append(_mix(whole) if words else np.empty(0, np.uint64))
        at += len(words)
    return out


def sketch(docs: DataFrame, n: int, bands: int, rows: int, doc: str, text: str) -> DataFrame:
    """A row number, the size and a 128-bit fingerprint of the n-gram set, and the band hashes of every document."""
    rng = np.random.default_rng(1)
    factors = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    kinds = {"__rid": T.LongType(), "__size": T.LongType(), "__fp1": T.LongType(), "__fp2": T.LongType(), "__bands": T.ArrayType(T.LongType())}
    held = docs.select(F.col(doc).alias("__doc"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__text"))
    schema = T.StructType([*held.schema.fields[:2], *[T.StructField(k, v) for k, v in kinds.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch, texts in text_chunks(batches, "__text"):
            sets = ngram_sets([t or b"" for t in texts], n)
            sizes = np.array([len(s) for s in sets])
            some = np.flatnonzero(sizes)
            fp = np.zeros((2, len(sets)), np.uint64)
            codes = np.zeros((len(sets), bands), np.uint64)
            if len(some):
                grams = np.concatenate([sets[i] for i in some])
                starts = np.cumsum(sizes[some]) - sizes[some]
                fp[0, some] = np.add.reduceat(_mix(grams), starts)
                fp[1, some] = np.add.reduceat(_mix(grams ^ _ODD), starts)
                for b in range(bands):
                    code = np.full(len(some), b, np.uint64)
                    for r in range(b * rows, (b + 1) * rows):
                        code = _mix(code * _ODD + np.minimum.reduceat(grams * factors[r] + shifts[r], starts))
                    codes[some, b] = code
            rid = number + np.arange(len(sets))
            number += len(sets)
            lists = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * bands, pa.array(codes.reshape(-1).view(np.int64)))
            columns = [batch.column("__doc"), batch.column("__hash"), pa.array(rid), pa.array(sizes), pa.array(fp[0].view(np.int64)), pa.array(fp[1].view(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return held.mapInArrow(run, schema)


def linked(sets: list[np.ndarray], threshold: tuple[int, int]) -> np.ndarray:
    """Which pairs of sets have at least the similarity; exact, from the sizes of all intersections."""
    n, (num, den) = len(sets), threshold
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1  # an n-gram of one set alone meets no other
    owner, column = owner[shared], column[shared]
    common = np.zeros((n, n))
    if len(column):
        column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1
        edges = np.searchsorted(column, np.arange(0, column[-1] + 1 + _COLUMNS, _COLUMNS))
        for lo, hi in zip(edges[:-1], edges[1:]):
            if lo < hi:
                part = np.zeros((n, column[hi - 1] - column[lo] + 1), np.float32)
                part[owner[lo:hi], column[lo:hi] - column[lo]] = 1
                common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    links = common * den >= num * union
    np.fill_diagonal(links, False)
    return links


def verify(cells: DataFrame, n: int, threshold: tuple[int, int]) -> DataFrame:
    """Links and the smallest linked document within its cell for every document of a cell that has a link there.

    A cell holds one block of a leader's members, or two whose cross pairs count.  A pair that meets under several leaders counts
    under the smallest only.
    """
    key = ("__leader", "__a", "__b")

    def links_of(rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        rows = list({r[3]: r for r in rows}.values())
        if len(rows) < 2:
            return
        leader, a, b = rows[0][:3]
        rid, copies, block = np.array([r[3] for r in rows]), np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
        links = linked([r[7] for r in rows], threshold)
        if a != b:
            links &= block[:, None] != block[None, :]
        if not links.any():
            return
        earlier = sorted({x for r in rows for x in r[6] if x < leader})
        if earlier:
            at = {x: i for i, x in enumerate(earlier)}
            member = np.zeros((len(rows), len(earlier)), np.float32)
            for i, r in enumerate(rows):
                member[i, [at[x] for x in r[6] if x < leader]] = 1
            links &= member @ member.T == 0
        counts = links @ copies
        root = np.arange(len(rows))
        order = np.argsort(rid)
        for start in order:  # depth first from the smallest document of each component
            if root[start] != start or not counts[start]:
                continue
            stack = [start]
            while stack:
                i = stack.pop()
                for j in np.flatnonzero(links[i] & (root == np.arange(len(rows)))):
                    if j != start:
                        root[j] = start
                        stack.append(j)
        for i in np.flatnonzero(counts):
            yield int(rid[i]), int(counts[i]), int(rid[root[i]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = [], []
        for batch, texts in text_chunks(batches, "__text"):
            sets = ngram_sets([t or b"" for t in texts], n)
            names = (*key, "__rid", "__copies", "__block", "__leaders")
            for row in zip(*[batch.column(c).to_pylist() for c in names], sets):
                if held and held[0][:3] != row[:3]:
                    found += links_of(held)
                    held = []
                held.append(row)
            if len(found) > 10_000:
                yield table(found)
                found = []
        found += links_of(held) if held else []
        if found:
            yield table(found)

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["rid", "links", "root"])

    return cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "rid long, links long, root long")


def ngram_join(
    docs: DataFrame, n: int = WORDS, threshold: tuple[int, int] = THRESHOLD, recall: float = RECALL,
    block_docs: int = BLOCK_DOCS, block_ngrams: int = BLOCK_NGRAMS, doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``class_id``, ``n_links``, ``copies`` and ``first``.

    Two documents are linked if the Jaccard similarity of their sets of word n-grams (words between white space, as they
    stand) is at least ``threshold``.  ``class_id`` is the smallest id that links lead to, ``n_links`` the number of other documents
    linked directly, ``copies`` the number of documents with the same n-grams, ``first`` marks one row of each class (the one with its id).
    A text of fewer than ``n`` words is one n-gram.  A null, empty or blank text has none: it is its own class without
    links.  A repeated row is a copy like any other; a null id is an id like any other and larger than all.  Other
    columns are left out; an empty table gives no rows.  N-grams are compared by 64-bit hashes.

    No pair is formed by a join.  Equal sets collapse first, by an aggregation.  A leader's members are cut into blocks of about
    ``block_docs`` documents or ``block_ngrams`` n-grams, each pair of blocks is verified in one cell of bounded size, and a cell gives back a
    count and one edge per document.  Buckets and classes are stored tables, so hot keys are split in the joins.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    bands, rows = banding(threshold[0] / threshold[1], recall)
    sketches = stage(sketch(docs, n, bands, rows, doc, text), "sketches")
    some = sketches.filter(F.col("__size") > 0)
    classes = stage(
        some.groupBy("__fp1", "__fp2").agg(F.min("__rid").alias("__rep"), F.count("*").alias("__copies"), F.min("__doc").alias("__class_doc")), "classes")
    rep = classes.select(F.col("__rep").alias("__rid"), "__copies")
    spread = some.join(rep, "__rid").select("__rid", "__size", "__copies", "__doc", "__hash", F.posexplode("__bands").alias("__band", "__code"))
    buckets = stage(
        spread.groupBy("__band", "__code").agg(F.min("__rid").alias("__leader"), F.count("*").alias("__n")).filter("__n > 1").drop("__n"), "buckets")
    members = stage(spread.join(buckets, ["__band", "__code"]).select("__leader", "__rid", "__size", "__copies", "__doc", "__hash").distinct(), "members")
    groups = stage(
        members.groupBy("__leader").agg(F.count("*").alias("__n"), F.sum("__size").alias("__ngrams"))
        .select("__leader", F.ceil(F.greatest(F.col("__n") / block_docs, F.col("__ngrams") / block_ngrams)).cast("int").alias("__blocks")), "groups",
    )
    of = members.groupBy("__rid", "__copies", "__doc", "__hash").agg(F.sort_array(F.collect_set("__leader")).alias("__leaders"))
    # One text for each id and hash, or a row that stands many times would come to its cells as often.  A struct holds the id, as
    # it is never null: the join then needs no other order than the aggregation's.
    key = [F.struct(F.col("__doc").alias("id")).alias("__id"), F.col("__hash").alias("__h")]
    bodies = (
        docs.select(F.col(doc).alias("__doc"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__text"))
        .groupBy(*key).agg(F.first("__text").alias("__text")))
    # A merge join at every size: the candidates grow with the input, so they are no side to broadcast.
    with_text = of.select("__rid", "__copies", "__leaders", *key).hint("merge").join(bodies, ["__id", "__h"])
    block = F.pmod(F.xxhash64("__rid"), "__blocks").cast("int")
    cells = (
        with_text.select("__rid", "__copies", "__leaders", "__text", F.explode("__leaders").alias("__leader"))
        .join(groups, "__leader").withColumn("__block", block)
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
        .select("__leader", F.least("__block", "__other").alias("__a"), F.greatest("__block", "__other").alias("__b"), "__rid", "__copies", "__block", "__leaders", "__text")
    )
    links = stage(verify(cells, n, threshold), "links")
    labels = components(links.filter("rid <> root"), "rid", "root")
    sums = links.groupBy("rid").agg(F.sum("links").alias("__links"))
    per_class = stage(
        classes.join(sums.withColumnRenamed("rid", "__rep"), "__rep", "left").join(labels.withColumnRenamed("node", "__rep"), "__rep", "left")
        .withColumn("__label", F.coalesce("label", "__rep")).drop("label"), "linked-classes")
    # The class's id, and the first row that has it.
    ids = stage(per_class.groupBy("__label").agg(F.min("__class_doc").alias("__class")), "class-ids")
    named = stage(per_class.join(ids, "__label").select("__fp1", "__fp2", "__copies", "__links", "__label", "__class"), "named-classes")
    rows_ = sketches.join(named, ["__fp1", "__fp2"], "left").withColumn("__lone", F.col("__size") == 0)
    heads = (
        rows_.filter(~F.col("__lone") & F.col("__doc").eqNullSafe(F.col("__class"))).groupBy("__label").agg(F.min("__rid").alias("__head")))
    result = rows_.join(stage(heads, "heads"), "__label", "left")
    return result.select(
        F.col("__doc").alias("doc_id"), F.col("__hash").alias("text_hash"),
        F.when(F.col("__lone"), F.col("__doc")).otherwise(F.col("__class")).alias("class_id"),
        F.when(F.col("__lone"), 0).otherwise(F.coalesce("__links", F.lit(0)) + F.col("__copies") - 1).cast("long").alias("n_links"),
        F.when(F.col("__lone"), 1).otherwise(F.col("__copies")).cast("long").alias("copies"),
        (F.col("__lone") | (F.col("__rid") == F.col("__head"))).alias("first"))
