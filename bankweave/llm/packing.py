"""Packing documents into token windows by the sum-of-squares rule.

A document that fits a window goes to the fill level that makes the sum of squares of the counts of partly filled
windows least; the counts are kept in an array by level.  Documents longer than a window first fill whole windows.
Each Spark partition packs its own documents, so nothing is shuffled.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bankweave.llm.common import bound_batches, text_chunks

END = (0).to_bytes(4, "little")
# Words whose ids a task keeps, and the longest of them: 32 MB at most, as a word takes about 200 bytes.
CACHE, LONGEST = 150_000, 40
# Fixed value: how a byte-level vocabulary of this kind splits a text.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space other than the blank and the line feed.
_OTHER_SPACE = re.compile(r"[^\S \n]")
_PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
])


def _byte_of() -> dict[str, int]:
    """Byte behind each character of a byte-level vocabulary: printable ones stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, as the byte-level vocabulary in ``path`` gives them.

    The vocabulary's expression splits a text before every blank between words, so ids are looked up by word and only
    words not met lately are encoded.  Texts where a blank may belong to a longer run of white space are encoded
    whole, and texts that may hold a special token by the vocabulary's own library.
    """

    def __init__(self, path: str, most: int = CACHE) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)
        special = {t["content"] for t in vocabulary["added_tokens"]}
        of = _byte_of()
        ranks = {bytes(map(of.__getitem__, t)): i for t, i in vocabulary["model"]["vocab"].items() if t not in special}
        self.words = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.marks = tuple(special)
        self.path, self.library, self.known, self.most = path, None, {}, most

    def _word(self, text: str) -> bytes:
        ids = self.words.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _special(self, text: str) -> bytes:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if any(mark in text for mark in self.marks):
            return self._special(text)
        if "  " in text or "\n \n" in text or _OTHER_SPACE.search(text):
            return self._word(text)
        first, *words = text.split(" ")
        known = self.known
        try:
            return self._word(first) + b"".join(map(known.__getitem__, words))
        except KeyError:
            parts = [self._word(first)]
            for w in words:
                ids = known.get(w)
                if ids is None:
                    ids = self._word(" " + w)
                    if len(w) <= LONGEST:
                        if len(known) >= self.most:
                            known.clear()
                        known[w] = ids
                parts.append(ids)
            return b"".join(parts)


class Packer:
    """Online packing of one partition; ``full`` collects closed windows as lists of (document, start, length, ids, tokens)."""

    def __init__(self, size: int, most_open: int) -> None:
        self.size, self.most_open = size, most_open
        self.counts = np.zeros(size + 1, np.int64)  # windows by level; the last one, full windows, stays 0
        self.open: list[list[list]] = [[] for _ in range(size)]
        self.held, self.full = 0, []
        self.moved = 0  # pieces taken out of the window that the rule chose

    def add(self, doc, ids: bytes) -> None:
        total = len(ids) // 4
        start = 0
        while total - start >= self.size:
            self.full.append([(doc, start, self.size, ids[4 * start : 4 * (start + self.size)], total)])
            start += self.size
        if start < total:
            self.place((doc, start, total - start, ids[4 * start :], total))
        if self.held > self.most_open:
            self.merge()

    def place(self, piece: tuple) -> None:
        n, counts = piece[2], self.counts
        levels = counts[1 : self.size - n + 1]
        change = 2 * (counts[n + 1 :] - levels) + 2
        change[-1:] -= 1  # the window that becomes full leaves the sum
        change[levels == 0] = np.iinfo(np.int64).max
        best, level = 2 * counts[n] + 1, 0
        if len(change):
            at = len(change) - 1 - int(np.argmin(change[::-1]))  # of equal changes, the fullest window
            if change[at] <= best:
                level = at + 1
        window = self.open[level].pop() if level else []
        if level:
            counts[level] -= 1
        window.append(piece)
        self.held += n
        if level + n == self.size:
            self.held -= self.size
            self.full.append(window)
        else:
            counts[level + n] += 1
            self.open[level + n].append(window)

    def merge(self) -> None:
        """Fill up the fullest of the partly filled windows by cutting what stands in the emptiest.

        As many windows stay as the ids held can fill; what the rule placed there stays in place.  At most one rest is left open.
        """
        windows = [(level, w) for level in range(self.size - 1, 0, -1) for w in self.open[level]]
        keep = self.held // self.size
        rest = [p for _, w in windows[keep:] for p in w]
        self.moved += len(rest)
        self.open, self.held = [[] for _ in range(self.size)], self.held % self.size
        self.counts[:] = 0
        rest.reverse()
        for level, window in windows[:keep]:
            gap = self.size - level
            while gap:
                head, left = cut(rest.pop(), gap)
                if left:
                    rest.append(left)
                window.append(head)
                gap -= head[2]
            self.full.append(window)
        if rest:
            self.open[self.held].append(rest[::-1])
            self.counts[self.held] = 1

    def close(self) -> None:
        """Merge what is left; the last rest is cut into windows whose lengths are powers of two, which need no padding."""
        self.merge()
        pieces = [p for level in self.open for window in level for p in window]
        room, window = 1 << max(0, self.held.bit_length() - 1), []
        left = self.held
        for piece in pieces:
            while piece:
                head, piece = cut(piece, room)
                window.append(head)
                room -= head[2]
                left -= head[2]
                if not room:
                    self.full.append(window)
                    window, room = [], 1 << max(0, left.bit_length() - 1)
        self.open, self.held = [[] for _ in range(self.size)], 0
        self.counts[:] = 0


def cut(piece: tuple, length: int) -> tuple[tuple, tuple | None]:
    doc, start, n, ids, total = piece
    if n <= length:
        return piece, None
    return (doc, start, length, ids[: 4 * length], total), (doc, start + length, n - length, ids[4 * length :], total)


def pack(
    docs: DataFrame, tokenizer: str, size: int = 1024, most_open: int = 4 << 20, with_ids: bool = False, doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece of a document: where it lies in its document and in its sequence, and a checksum of its ids.

    ``tokenizer`` is the path of a vocabulary file that every executor can read.  Every document ends with id 0; a
    null or empty text is that id alone.  Repeated rows are packed as often as they come, a null id passes through,
    other columns are left out.  An empty table gives no row.  Windows hold at most ``size`` ids.  At the end of a partition, and
    when its partly filled windows hold over ``most_open`` ids, the fullest are filled up from the emptiest by cutting, which bounds memory for
    any sizes and leaves no padding.  Sequence ids hold the partition in their upper bits.  ``with_ids`` adds the ids of each piece.
    """
    bound_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc].dataType), *_PIECES.fields[1:]])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))
    kinds = [_arrow(f.dataType) for f in schema.fields]
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(tokenizer), Packer(size, most_open)
        number = TaskContext.get().partitionId() << 40

        def rows() -> pa.RecordBatch:
            nonlocal number
            columns: list[list] = [[] for _ in names]
            for window in packer.full:
                at = 0
                for owner, start, n, ids, total in window:
                    row = (owner, start, n, zlib.crc32(ids), total, number, at)
                    for column, value in zip(columns, row):
                        column.append(value)
                    if with_ids:
                        columns[-1].append(np.frombuffer(ids, "<u4").astype("int32"))
                    at += n
                number += 1
            packer.full = []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch, texts in text_chunks(batches, text):
            owners = batch.column(doc).to_pylist()
            for owner, t in zip(owners, texts):
                packer.add(owner, encoder.encode((t or b"").decode("utf-8", "replace")) + END)
            if packer.full:
                yield rows()
        packer.close()
        if packer.full:
            yield rows()

    return docs.select(doc, text).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
