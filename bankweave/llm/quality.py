"""Quality rules: base counts, and distribution divergence against language references.

Every language has two reference histograms, summed over all its documents: character classes (Unicode categories)
and common words (words with at least one in a thousand of the language's words; all others share one bin).  A
document is compared with the references by Jensen-Shannon distance.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankweave.llm.common import bound_batches, frequent, text_chunks
from bankweave.session import stage

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent
SYMBOLS = b"#*$%&|<>"
SHARE = 1000  # a common word makes up at least one in so many words
COUNTERS = 4 * SHARE
MAX_LANGS = 1000
# A distance counts as strange over LIMIT + SLACK / sqrt(length): short histograms are noisy.  Under the least
# length a histogram says too little and is not judged.
CHAR_LIMIT, CHAR_SLACK, CHAR_LEAST = 0.17, 2.0, 100
WORD_LIMIT, WORD_SLACK, WORD_LEAST = 0.36, 0.6, 40

_BASE = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])


# Classes of characters: the two-letter Unicode categories; the line feed and the blank have their own.
CATEGORIES = [
    "Cc", "Cf", "Cn", "Co", "Cs", "Ll", "Lm", "Lo", "Lt", "Lu", "Mc", "Me", "Mn", "Nd", "Nl", "No", "Pc", "Pd", "Pe", "Pf",
    "Pi", "Po", "Ps", "Sc", "Sk", "Sm", "So", "Zl", "Zp", "Zs", "blank", "newline",
]
_TABLE = 0x3000


def _class(point: int) -> int:
    return CATEGORIES.index({10: "newline", 32: "blank"}.get(point) or unicodedata.category(chr(point)))


def class_table() -> np.ndarray:
    return np.array([_class(i) for i in range(_TABLE)], np.uint8)


def class_counts(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Characters per text and class."""
    n = len(CATEGORIES)
    points = [np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for t in texts]
    row = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    flat = np.concatenate(points) if points else np.empty(0, np.uint32)
    far = np.flatnonzero(flat >= _TABLE)
    flat, rare = table[np.minimum(flat, _TABLE - 1)], flat[far]
    if len(far):
        kinds, at = np.unique(rare, return_inverse=True)
        flat[far] = np.array([_class(int(c)) for c in kinds], np.uint8)[at]
    return np.bincount(row * n + flat, minlength=len(texts) * n).reshape(len(texts), n)


def words_of(text: bytes) -> list[bytes]:
    """Words for the histogram, in lower case."""
    return text.decode("utf-8", "replace").lower().encode().split()


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of ``WINDOW`` words that occur twice or more; windows are compared exactly."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    width = 1
    while width < WINDOW:  # numbers of windows of twice the width, until no window of a width repeats
        pair = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        _, ids, counts = np.unique(pair, return_inverse=True, return_counts=True)
        width *= 2
        if len(counts) == len(pair):
            return 0
    starts = np.flatnonzero(counts[ids] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    continued = len(text) - len(text.decode("utf-8", "replace")) if not text.isascii() else 0
    seen: set[bytes] = set()
    repeats = 0
    for line in text.split(b"\n"):
        if line in seen:
            repeats += 1
        elif line.strip():
            seen.add(line)
    return len(words), sum(map(len, words)) - continued, sum(text.count(bytes([c])) for c in SYMBOLS), repeats, repeated_words(words)


def common_words(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """Candidates for the common words of each language: every word with a share of 1 / SHARE of its words, and few others.

    Each task keeps ``COUNTERS`` Misra-Gries counters per language, which fall short by at most 1 / COUNTERS of the words that
    it saw.  Summed over all tasks, a word's counters fall short by at most 1 / COUNTERS of all words, so none is missed; as
    they sum to no more than all words, at most SHARE * 4 / 3 words a language pass, however many tasks there are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}
        seen: Counter = Counter()
        for batch, texts in text_chunks(batches, text):
            langs = np.array(batch.column(lang).to_pylist(), object)
            for name in set(langs):
                words = [w for at in np.flatnonzero(langs == name) for w in words_of(texts[at] or b"")]
                seen[name] += len(words)
                own = counters.setdefault(name, Counter())
                own.update(words)
                if len(own) > COUNTERS:
                    bar = sorted(own.values(), reverse=True)[COUNTERS]
                    counters[name] = Counter({w: c - bar for w, c in own.items() if c > bar})
        rows = [(n, w.decode(), c) for n, own in counters.items() for w, c in own.items()] + [(n, None, c) for n, c in seen.items()]
        if rows:
            kinds = [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["lang", "word", "n"])

    held = docs.select(lang, text).filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counted = stage(held.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "common-words")
    seen = counted.filter("word IS NULL").select("lang", F.col("n").alias("seen"))
    enough = F.col("n") + F.col("seen") / COUNTERS >= F.col("seen") / SHARE
    return counted.filter("word IS NOT NULL").join(seen, "lang").filter(enough).select("lang", "word")


class References:
    """Histograms per language: shares of character classes, and shares of the common words and of all others."""

    def __init__(self, langs: list[str], classes: np.ndarray, words: list[dict[str, int]], totals: list[int]) -> None:
        self.langs = langs
        self.classes = classes / np.maximum(classes.sum(axis=1, keepdims=True), 1)
        common = [{w: c for w, c in own.items() if c * SHARE >= n and n} for own, n in zip(words, totals)]
        self.vocabulary = {w.encode(): i for i, w in enumerate(sorted({w for own in common for w in own}))}
        self.shares = np.zeros((len(langs), len(self.vocabulary)))
        for i, (own, n) in enumerate(zip(common, totals)):
            for w, c in own.items():
                self.shares[i, self.vocabulary[w.encode()]] = c / n


def fit_references(docs: DataFrame, lang: str = "lang", text: str = "text", most_langs: int = MAX_LANGS) -> References:
    """References from all documents with a language and a text; of more than ``most_langs`` languages the most frequent have one.

    The driver and the tasks hold at most SHARE * 4 / 3 words and a histogram a language.
    """
    bound_batches(docs.sparkSession)
    known = [name for name, _ in frequent(docs, lang, most_langs)]
    docs = docs.filter(F.col(lang).isin(known))
    candidates: dict[str, list[str]] = {}
    for r in common_words(docs, lang, text).collect():
        candidates.setdefault(r["lang"], []).append(r["word"])
    wanted = {name: {w.encode() for w in words} for name, words in candidates.items()}
    names = sorted(candidates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        table = class_table()
        for batch, texts in text_chunks(batches, text):
            langs = batch.column(lang).to_pylist()
            for name, row in zip(langs, class_counts([t or b"" for t in texts], table)):
                for i in np.flatnonzero(row):
                    totals[name, "c", str(i)] += int(row[i])
            for name in set(langs):
                counts = Counter(w for own, t in zip(langs, texts) if own == name for w in words_of(t or b""))
                totals[name, "n", ""] += counts.total()
                for w in wanted.get(name, set()) & counts.keys():
                    totals[name, "w", w.decode()] += counts[w]
        if totals:
            keys = list(totals)
            columns = [*zip(*keys), [totals[k] for k in keys]]
            kinds = [pa.string()] * 3 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "kind", "item", "n"])

    counted = docs.select(lang, text).filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).mapInArrow(run, "lang string, kind string, item string, n long")
    classes, words, sizes = np.zeros((len(names), len(CATEGORIES))), [{} for _ in names], [0] * len(names)
    for r in counted.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")).collect():
        if r["lang"] not in wanted:
            continue
        i = names.index(r["lang"])
        if r["kind"] == "c":
            classes[i, int(r["item"])] = r["n"]
        elif r["kind"] == "w":
            words[i][r["item"]] = r["n"]
        else:
            sizes[i] = r["n"]
    return References(names, classes, words, sizes)


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Summands of the Jensen-Shannon divergence in bits where ``p`` is not 0, less those where it is (q / 2)."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        own = np.where(p > 0, p * np.log2(p / m), 0)
        other = np.where(q > 0, q * np.log2(q / m), 0)
    return (own + other) / 2 - q / 2


def distances(refs: References, texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Jensen-Shannon distances of classes and of words to every language, characters and words per text."""
    classes = class_counts(texts, table)
    chars = classes.sum(axis=1)
    shares = classes / np.maximum(chars, 1)[:, None]
    by_class = np.stack([0.5 + _divergence(shares, ref[None]).sum(axis=1) for ref in refs.classes], axis=1)
    split = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in split])
    get, n = refs.vocabulary.get, max(1, len(refs.vocabulary))
    codes = np.array([get(w, -1) for words in split for w in words], np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)[codes >= 0]
    cells, counts = np.unique(row * n + codes[codes >= 0], return_counts=True)
    row, code = cells // n, cells % n
    by_word = np.empty((len(texts), len(refs.langs)))
    for i, ref in enumerate(refs.shares):
        # Words that are not common in this language fall into its bin of all others.
        own = ref[code] > 0
        p, q = counts[own] / lengths[row[own]], ref[code[own]]
        common = np.bincount(row[own], weights=p, minlength=len(texts))
        rest = _divergence(np.clip(1 - common, 0, 1), np.full(len(texts), max(0.0, 1 - ref.sum())))
        by_word[:, i] = 0.5 + np.bincount(row[own], weights=_divergence(p, q), minlength=len(texts)) + rest
    return np.sqrt(np.clip(by_class, 0, 1)), np.sqrt(np.clip(by_word, 0, 1)), chars, lengths


def judge(
    docs: DataFrame, refs: References, char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT, text: str = "text",
) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``char_distance``, ``word_distance`` and ``kept``.

    A document fails the base with fewer than ``MIN_WORDS`` words, or if over ``MAX_REPEATED`` per cent of them lie in
    repeated windows.  Otherwise the language whose common words are nearest is taken (the language column is not
    asked, so a wrong or missing label does no harm) and the document is kept unless its distance to that reference is over
    ``char_limit`` + CHAR_SLACK / sqrt(characters) by character classes or over ``word_limit`` + WORD_SLACK / sqrt(words)
    by common words.  Under CHAR_LEAST characters or WORD_LEAST words the respective histogram is not judged (distance
    null), and without references neither is.  A null text has no words and fails.  Rows are judged one by one,
    so repeated rows, very long texts and empty tables need no care; columns named like the added ones are replaced
    and all others pass through.
    """
    bound_batches(docs.sparkSession)
    added = T.StructType([
        *_BASE.fields, T.StructField("base_failed", T.BooleanType()), T.StructField("char_distance", T.DoubleType()),
        T.StructField("word_distance", T.DoubleType()), T.StructField("kept", T.BooleanType()),
    ])
    docs = docs.drop(*[c for c in added.fieldNames() if c != text])
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        for batch, texts in text_chunks(batches, text):
            texts = [t or b"" for t in texts]
            base = pd.DataFrame([base_counts(t) for t in texts], columns=_BASE.fieldNames())
            failed = ((base.n_words < MIN_WORDS) | (100 * base.n_repeat_words > MAX_REPEATED * base.n_words)).to_numpy()
            char, word = np.full(len(texts), np.nan), np.full(len(texts), np.nan)
            chars = lengths = base.n_words.to_numpy()
            if refs.langs:
                by_class, by_word, chars, lengths = distances(refs, texts, table)
                # Short texts choose by characters alone.
                nearest = np.where((lengths >= WORD_LEAST)[:, None], by_word, by_class).argmin(axis=1)
                rows = np.arange(len(texts))
                char = np.where(chars >= CHAR_LEAST, by_class[rows, nearest], np.nan)
                word = np.where(lengths >= WORD_LEAST, by_word[rows, nearest], np.nan)
            with np.errstate(divide="ignore"):
                strange = (char > char_limit + CHAR_SLACK / np.sqrt(chars)) | (word > word_limit + WORD_SLACK / np.sqrt(lengths))
            kept = ~failed & ~strange
            columns = [*[base[c].to_numpy() for c in base], failed, char, word, kept]
            extra = [pa.array(c, k, from_pandas=True) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *added.fieldNames()])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))
