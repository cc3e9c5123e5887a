"""Alignment of two tokenizers over the same texts.

Both tokenizations of a text cover the same bytes.  Each is a token-by-byte incidence matrix A or B in compressed rows; the
product A B' holds for every pair of tokens the bytes that they share, so its non-zero places are the overlap links.  Where tokens of
both end at the same byte, the text falls apart into groups; token-by-group matrices give the links of tokens that share a
group in the same way.  Rows are multiplied one by one after Gustavson, many rows per NumPy call.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankweave.llm.common import bound_batches, text_chunks
from bankweave.session import stage

# Fixed value: how a byte-level vocabulary of this kind splits a text.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_PAIRS = 2_000_000  # id pairs that tasks hold at a time, 17 bytes each
_BLOCK = 1 << 20
_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")


@dataclass
class Rows:
    """A sparse matrix in compressed rows: the columns of row i are ``columns[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int


def incidence(ends: np.ndarray, low: int, high: int) -> Rows:
    """Tokens by bytes of the range ``low`` to ``high``; token i holds the bytes from the end of the one before it to ``ends[i]``."""
    starts = np.concatenate([[0], np.clip(ends, low, high) - low])
    return Rows(starts, np.arange(high - low), np.ones(high - low, np.int64), high - low)


def membership(groups: np.ndarray, width: int) -> Rows:
    """Tokens by groups: every token lies in one."""
    return Rows(np.arange(len(groups) + 1), groups, np.ones(len(groups), np.int64), width)


def transposed(m: Rows) -> Rows:
    """Counting sort by column."""
    row = np.repeat(np.arange(len(m.starts) - 1), np.diff(m.starts))
    order = np.argsort(m.columns, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(m.columns, minlength=m.width))])
    return Rows(starts, row[order], m.values[order], len(m.starts) - 1)


def row_sizes(a: Rows, b: Rows) -> np.ndarray:
    """Products that each row of A B adds up.  Where A has one entry a row, that is the row's number of non-zero places."""
    each = np.diff(b.starts)[a.columns]
    total = np.concatenate([[0], np.cumsum(each)])
    return total[a.starts[1:]] - total[a.starts[:-1]]


def multiply(a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of A B: every entry of a row of A brings in a row of B, scaled, and equal columns are added up."""
    size = np.diff(b.starts)[a.columns]
    row = np.repeat(np.repeat(np.arange(len(a.starts) - 1), np.diff(a.starts)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(b.starts[a.columns], size)
    column, value = b.columns[at], np.repeat(a.values, size) * b.values[at]
    key = row * b.width + column
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    if not len(key):
        return key, key, value
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first] // b.width, key[first] % b.width, np.add.reduceat(value, first)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, block: int = _BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of tokens whose bytes overlap, and how many they share, for blocks of A's tokens of about ``block`` bytes."""
    first = 0
    while first < len(a_ends):
        low = int(a_ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(a_ends, low + block, "right")))
        high = int(a_ends[last - 1])
        b_first, b_last = int(np.searchsorted(b_ends, low, "right")), int(np.searchsorted(b_ends, high, "left")) + 1
        i, j, shared = multiply(incidence(a_ends[first:last], low, high), transposed(incidence(b_ends[b_first:b_last], low, high)))
        yield i + first, j + b_first, shared
        first = last


class Tokenizers:
    """Both tokenizers, with the bytes that each id stands for."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        import sentencepiece
        import tiktoken

        with open(byte_level, encoding="utf-8") as file:
            vocabulary = json.load(file)
        special = {t["content"] for t in vocabulary["added_tokens"]}
        # Printable characters stand for their byte, those from 256 on for the other bytes.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in vocabulary["model"]["vocab"].items() if t not in special}
        self.a = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes = {i: t for t, i in ranks.items()}
        size = self.b.get_piece_size()
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(size)]
        self.a_size, self.b_size = max(self.a_bytes) + 1, size
        self.a_lengths = np.array([len(self.a_bytes.get(i, b"")) for i in range(self.a_size)])
        self.b_lengths = np.array([len(x) for x in self.b_bytes])
        # Decimal digits of every id, one place left for what follows it; 0 where there is no digit.
        most = max(self.a_size, size)
        width = len(str(most))
        self.digits = np.zeros((most, width + 1), np.uint8)
        left = np.arange(most)
        for place in range(width - 1, -1, -1):
            self.digits[:, place] = np.where((left > 0) | (place == width - 1), left % 10 + 48, 0)
            left //= 10

    def encode(self, texts: list[bytes | None]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """Places of the texts that both tokenizers give back byte by byte, and their ids."""
        some = [i for i, t in enumerate(texts) if t]
        read = [texts[i].decode("utf-8", "replace") for i in some]
        kept, a_ids, b_ids = [], [], []
        for i, text, b in zip(some, read, self.b.encode(read, num_threads=1) if read else []):
            whole = b" " + texts[i]
            a = self.a.encode_to_numpy(" " + text, disallowed_special=())
            if b"".join(map(self.b_bytes.__getitem__, b)) == whole and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == whole:
                kept.append(i)
                a_ids.append(a.astype(np.int64))
                b_ids.append(np.array(b, np.int64))
        return kept, a_ids, b_ids


def worker_tokenizers(byte_level: str, pieces: str) -> Tokenizers:
    """The tokenizers of this worker process, which later tasks find again; one pair at a time."""
    kept = sys.modules.setdefault("_bankweave_aligned", ModuleType("_bankweave_aligned")).__dict__
    if kept.get("paths") != (byte_level, pieces):
        kept.update(paths=(byte_level, pieces), pair=Tokenizers(byte_level, pieces))
    return kept["pair"]


def aligned(tokenizers: Tokenizers, texts: list[bytes | None], with_text: bool) -> dict[str, list]:
    """Counts, groups and links by id pair of every text.  The texts lie one behind the other in one pair of matrices."""
    n = len(texts)
    out: dict[str, list] = {c: [0] * n for c in _COUNTS} | {"groups": [""] * n} | {c: [[]] * n for c in ("a", "b", "n")}
    kept, a_ids, b_ids = tokenizers.encode(texts)
    if not kept:
        return out
    a, b = np.concatenate(a_ids), np.concatenate(b_ids)
    a_ends, b_ends = np.cumsum(tokenizers.a_lengths[a]), np.cumsum(tokenizers.b_lengths[b])
    a_last, b_last = np.cumsum([len(x) for x in a_ids]), np.cumsum([len(x) for x in b_ids])
    doc = np.repeat(np.arange(len(kept)), np.diff(a_last, prepend=0))
    group_ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
    a_group, b_group = np.searchsorted(group_ends, a_ends), np.searchsorted(group_ends, b_ends)
    shared = row_sizes(membership(a_group, len(group_ends)), transposed(membership(b_group, len(group_ends))))
    keys = []
    for i, j, _ in overlaps(a_ends, b_ends):
        keys.append((doc[i] * tokenizers.a_size + a[i]) * tokenizers.b_size + b[j])
    pairs, counts = np.unique(np.concatenate(keys), return_counts=True)
    owner = pairs // (tokenizers.a_size * tokenizers.b_size)
    pair_starts = np.searchsorted(owner, np.arange(len(kept) + 1))
    pair_a, pair_b = pairs // tokenizers.b_size % tokenizers.a_size, pairs % tokenizers.b_size
    # A's ids of a group come first, then B's.
    ids, mark = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
    for own, group, at, after in (
        (a, a_group, np.arange(len(a)) + np.searchsorted(b_group, a_group, "left"), b"|"), (b, b_group, np.arange(len(b)) + np.searchsorted(a_group, b_group, "right"), b";"),
    ):
        ids[at], mark[at] = own, np.where(np.append(group[1:] == group[:-1], False), ord(","), ord(after))
    mark[a_last + b_last - 1] = 0
    groups = np.diff(np.searchsorted(group_ends, a_ends[a_last - 1]) + 1, prepend=0)
    links = np.bincount(owner, weights=counts, minlength=len(kept)).astype(np.int64)
    in_groups = np.bincount(doc, weights=shared, minlength=len(kept)).astype(np.int64)
    start = 0
    for k, i in enumerate(kept):
        end = int(a_last[k] + b_last[k])
        for name, value in zip(_COUNTS, (len(a_ids[k]), len(b_ids[k]), groups[k], links[k], in_groups[k])):
            out[name][i] = int(value)
        written = _written(tokenizers.digits, ids, mark, start, end)
        if with_text:
            out["groups"][i] = b"".join(written).decode()
        else:
            digest = hashlib.sha256()
            for part in written:
                digest.update(part)
            out["groups"][i] = digest.hexdigest()
        own = slice(pair_starts[k], pair_starts[k + 1])
        for name, values in (("a", pair_a), ("b", pair_b), ("n", counts)):
            out[name][i] = values[own]
        start = end
    return out


def _written(digits: np.ndarray, ids: np.ndarray, mark: np.ndarray, start: int, end: int) -> Iterator[bytes]:
    for at in range(start, end, _BLOCK):
        stop = min(end, at + _BLOCK)
        text = digits[ids[at:stop]]
        text[:, -1] = mark[at:stop]
        yield text[text != 0].tobytes()


def align(
    docs: DataFrame, byte_level: str, pieces: str, with_text: bool = False, most_pairs: int = MOST_PAIRS, doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, tokens ``n_a`` and ``n_b``, ``n_groups``, ``n_links`` (pairs of token occurrences that overlap),
    ``n_shared`` (pairs that share a group), ``groups``, links by id pair as arrays ``a``, ``b`` and ``n``, ``n_best`` (links whose id pair has
    the highest count of its B id, ties included) and ``count_sum`` (sum of the counts of the links' id pairs).

    Tokenizer A reads a blank and the text, B the text, to which it adds that blank; special tokens are plain text to both.  ``byte_level`` and
    ``pieces`` are paths of vocabulary files that every executor can read.  ``groups`` is the SHA-256 of the groups' text (`a1,a2|b1;a3|b2`), with
    ``with_text`` the text.  A text that is null or empty, or that a tokenizer does not give back byte by byte, has no tokens: counts are 0,
    ``groups`` is empty.  A null id passes through, repeated rows count as often as they come, other columns are left out, an
    empty table gives no rows.  Texts of any length are read whole, their matrices built block by block.

    Texts are read once; what is stored holds the counts and links.  Counts by id pair are summed within tasks first.  The table of
    id pairs, bounded by the two vocabularies alone, goes to the tasks in slices of at most about ``most_pairs``: one slice, unless there are more pairs,
    and a pass over the stored links for each slice.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    longs = [T.StructField(c, T.LongType()) for c in (*_COUNTS, "n_best", "count_sum")]
    lists = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("a", "b", "n")]
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc].dataType), *longs, T.StructField("groups", T.StringType()), *lists])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = worker_tokenizers(byte_level, pieces)
        for batch, texts in text_chunks(batches, text):
            found = aligned(tokenizers, texts, with_text)
            zeros = pa.array(np.zeros(len(texts), np.int64))
            columns = [batch.column(doc), *[pa.array(found[c], pa.int64()) for c in _COUNTS], zeros, zeros, pa.array(found["groups"], pa.string())]
            sizes = np.concatenate([[0], np.cumsum([len(x) for x in found["a"]])]).astype(np.int32)
            for c in ("a", "b", "n"):
                columns.append(pa.ListArray.from_arrays(sizes, pa.array(np.concatenate([np.asarray(x, np.int32) for x in found[c]]))))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    result = stage(docs.select(doc, text).mapInArrow(read, schema), "aligned")
    counts = stage(pair_counts(result), "id-pairs")
    best = counts.groupBy("b").agg(F.max("count").alias("top"))
    table = counts.join(best, "b").select(_key().alias("key"), "count", (F.col("count") == F.col("top")).alias("best"))
    slices = max(1, -(-counts.count() // most_pairs))
    if slices > 1:
        table = stage(table.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(slices))), "id-pair-slices")
    for k in range(slices):
        part = table if slices == 1 else table.filter(F.col("slice") == k)
        held = part.select("key", "count", "best").toArrow()  # at most about most_pairs rows
        result = weigh(result, *[held.column(i).to_numpy() for i in range(3)])
        if k < slices - 1:
            result = stage(result, "weighed")
    return result


def _key():
    return F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")


def pair_counts(links: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``count`` over all documents; tasks add up what they meet before it is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, waiting, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every, at = np.unique(np.concatenate([keys, *[k for k, _ in waiting]]), return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, at, np.concatenate([sums, *[s for _, s in waiting]]))
            return every, total

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(sums)], names=["a", "b", "count"])

        for batch in batches:
            a, b, n = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("a", "b", "n"))
            waiting.append(((a << 32) + b, n))
            size += len(a)
            if size > 4 * _BLOCK:
                keys, sums = merged()
                waiting, size = [], 0
                if len(keys) > _BLOCK:
                    yield rows()
                    keys, sums = keys[:0], sums[:0]
        keys, sums = merged()
        if len(keys):
            yield rows()

    return links.select("a", "b", "n").mapInArrow(run, "a int, b int, count long").groupBy("a", "b").agg(F.sum("count").alias("count"))


def weigh(links: DataFrame, keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """Add what the links of the given id pairs bring to ``n_best`` and ``count_sum``."""
    order = np.argsort(keys)
    keys, counts, best = keys[order], counts[order], best[order].astype(np.int64)
    names = links.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("a")
            a, b, n = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("a", "b", "n"))
            sizes = np.diff(lists.offsets.to_numpy())
            key = (a << 32) + b
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                n = np.where(keys[at] == key, n, 0)
                added = {"n_best": n * best[at], "count_sum": n * counts[at]}
            else:
                added = {"n_best": np.zeros(len(n), np.int64), "count_sum": np.zeros(len(n), np.int64)}
            ends = np.cumsum(sizes)
            columns = []
            for name in names:
                column = batch.column(name)
                if name in added:
                    running = np.concatenate([[0], np.cumsum(added[name])])
                    column = pa.array(column.to_numpy() + running[ends] - running[ends - sizes])
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return links.mapInArrow(run, links.schema)
