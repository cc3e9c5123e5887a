"""Language identification by interpolated Kneser-Ney models of characters.

Each language has a model of order four over the letters of its words.  Probabilities of seen n-grams and back-off
weights of seen contexts are stored in arrays sorted by hash, one column per language.  A text gets the language with the
lowest cross-entropy per character; a text whose cross-entropy is high even there is marked as rejected.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankweave.llm.common import bound_batches, frequent, text_chunks
from bankweave.session import stage

ORDER = 4
FIRST, LAST = "\x02", "\x03"  # stand before and after every word
MAX_DOCS = 2000
MAX_LANGS = 1000
REJECT = 0.999  # share of a language's own texts that its limit accepts
CACHE = 300_000
_LETTERS = re.compile(r"[^\W\d_]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def sample(docs: DataFrame, learn: Column, most: int, doc: str, lang: str, most_langs: int = MAX_LANGS) -> DataFrame:
    """About ``most`` documents per language for fitting, all if there are fewer: those whose id hashes into the share that the
    language's count asks for.  Of more than ``most_langs`` languages the most frequent are learned.

    Only the counts, a row a language, are gathered.  Rows are chosen where they lie, so no text is shuffled.
    """
    usable = docs.filter(learn & F.col(lang).isNotNull() & F.col(doc).isNotNull())
    place = (F.xxhash64(F.col(doc)).cast("double") / 2.0**63 + 1) / 2
    shares = {name: min(1.0, most / n) for name, n in frequent(usable, lang, most_langs)}
    if not shares:
        return usable.limit(0)
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
    return usable.filter(F.coalesce(place < F.try_element_at(share, F.col(lang)), F.lit(False)))


def count_grams(sampled: DataFrame, lang: str, text: str) -> DataFrame:
    """Counts of every language's n-grams; each is as long as the order, or reaches back to the start of its word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, text):
            counts: dict[tuple[str, str], int] = defaultdict(int)
            for name, t in zip(batch.column(lang).to_pylist(), texts):
                for w in words_of((t or b"").decode("utf-8", "replace")):
                    counts[name, w] += 1
            if counts:
                names, words = zip(*counts)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(words), pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])

    words = sampled.select(lang, text).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    padded = words.withColumn("s", F.concat(F.lit(FIRST), "word", F.lit(LAST)))
    grams = F.expr(f"transform(sequence(2, char_length(s)), i -> substring(s, greatest(i - {ORDER - 1}, 1), least(i, {ORDER})))")
    return padded.select("lang", F.explode(grams).alias("gram"), "n").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: dict[str, int], alphabet: int) -> tuple[dict[str, float], dict[str, float], float]:
    """Probability of every seen n-gram given its context, back-off weight of every seen context (and of none at all)."""
    by_order: list[dict[str, int]] = [{} for _ in range(ORDER + 1)]
    for g, c in counts.items():
        by_order[len(g)][g] = c
    for k in range(ORDER, 1, -1):  # below the top, an n-gram counts once for each character seen in front of it
        for g in list(by_order[k]):
            by_order[k - 1][g[1:]] = by_order[k - 1].get(g[1:], 0) + 1
    probability: dict[str, float] = {}
    weight: dict[str, float] = {}
    for k in range(1, ORDER + 1):
        own = by_order[k]
        ones, twos = sum(c == 1 for c in own.values()), sum(c == 2 for c in own.values())
        discount = min(0.9, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))
        total: dict[str, int] = defaultdict(int)
        kinds: dict[str, int] = defaultdict(int)
        for g, c in own.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        for h in total:
            weight[h] = discount * kinds[h] / total[h]
        for g, c in own.items():
            lower = probability[g[1:]] if k > 1 else 1 / alphabet
            probability[g] = max(c - discount, 0) / total[g[:-1]] + weight[g[:-1]] * lower
    return probability, weight, weight.get("", 1.0) / alphabet


def hash_grams(codes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` characters that end at each place."""
    out = np.zeros(len(codes), np.uint64)
    for back in range(length - 1, -1, -1):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[back:] = codes[: len(codes) - back] if back else codes
        out = out * _FACTOR + shifted + np.uint64(1)
    out = (out ^ np.uint64(length)) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(31))


def _hash_all(grams: list[str]) -> np.ndarray:
    out = np.zeros(len(grams), np.uint64)
    for k in range(1, ORDER + 1):
        at = [i for i, g in enumerate(grams) if len(g) == k]
        if at:
            codes = np.frombuffer("".join(grams[i] for i in at).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            out[at] = hash_grams(codes, k)[k - 1 :: k]
    return out


@dataclass
class Model:
    langs: list[str]
    keys: np.ndarray
    logs: np.ndarray  # log2 probability by n-gram and language
    contexts: np.ndarray
    weights: np.ndarray  # log2 back-off weight by context and language
    unseen: np.ndarray  # log2 probability of a character that was never seen
    limits: np.ndarray  # highest cross-entropy that is not rejected

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log2 probability by word and language, and the number of letters (0 for a word without any)."""
        letters = np.array([sum(map(str.isalpha, w)) for w in words])
        flat = np.frombuffer("".join(f"{FIRST}{w}{LAST}" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.array([len(w) + 2 for w in words])
        starts = np.cumsum(lengths) - lengths
        place = np.arange(len(flat)) - np.repeat(starts, lengths)
        hashes = [hash_grams(flat, k) for k in range(1, ORDER + 1)]
        score = np.zeros((len(flat), len(self.langs)))
        open_ = place > 0
        for k in range(ORDER, 0, -1):
            at = np.flatnonzero(open_ & (place + 1 >= k) & (place > 0))
            if not len(at):
                continue
            found = np.searchsorted(self.keys, hashes[k - 1][at])
            hit = self.keys[np.minimum(found, len(self.keys) - 1)] == hashes[k - 1][at]
            score[at[hit]] += self.logs[found[hit]]
            open_[at[hit]] = False
            miss = at[~hit]
            if k > 1:
                before = hashes[k - 2][miss - 1]
                found = np.minimum(np.searchsorted(self.contexts, before), len(self.contexts) - 1)
                known = self.contexts[found] == before
                score[miss[known]] += self.weights[found[known]]
            else:
                score[miss] += self.unseen
        return np.add.reduceat(score, starts, axis=0), letters


def build(counts: dict[str, dict[str, int]]) -> Model:
    """Model of all languages.  For an n-gram that only other languages have seen, the backed-off value is stored."""
    langs = sorted(counts)
    alphabet = len({c for own in counts.values() for g in own for c in g}) + 1
    fitted = [kneser_ney(counts[x], alphabet) for x in langs]
    grams = sorted({g for p, _, _ in fitted for g in p})
    heads = sorted({h for _, w, _ in fitted for h in w if h})

    def value(i: int, g: str) -> float:
        p, w, unseen = fitted[i]
        scale = 1.0
        while g not in p:
            if len(g) == 1:
                return scale * unseen
            scale *= w.get(g[:-1], 1.0)
            g = g[1:]
        return scale * p[g]

    logs = np.log2([[value(i, g) for i in range(len(langs))] for g in grams]) if grams else np.zeros((0, len(langs)))
    weights = np.log2([[w.get(h, 1.0) for _, w, _ in fitted] for h in heads]) if heads else np.zeros((0, len(langs)))
    keys, contexts = _hash_all(grams), _hash_all(heads)
    a, b = np.argsort(keys), np.argsort(contexts)
    return Model(langs, keys[a], logs[a], contexts[b], weights[b], np.log2([u for _, _, u in fitted] or [1.0])[: len(langs)], np.full(len(langs), np.inf))


def fit(
    docs: DataFrame, learn: Column | None = None, max_docs: int = MAX_DOCS, reject: float = REJECT,
    doc: str = "doc_id", lang: str = "lang", text: str = "text",
) -> Model:
    """Model from about ``max_docs`` labelled documents a language, of those where ``learn`` holds.

    That bound, an expected number, is a parameter of the fit alone; it also bounds the n-gram counts that come to the driver, and the stored
    sample that both passes of the fit read.  Rows without language, id or text are not used.  Repeated ids count each.  The limit of each language is calibrated on the same documents.
    """
    bound_batches(docs.sparkSession)
    sampled = sample(docs, F.lit(True) if learn is None else learn, max_docs, doc, lang).filter(F.col(text).isNotNull())
    sampled = stage(sampled.select(doc, lang, text), "language-sample")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for r in count_grams(sampled, lang, text).collect():
        counts[r["lang"]][r["gram"]] = r["n"]
    model = build(counts)
    if model.langs:
        scored = predict(sampled.select(doc, F.col(lang).alias("__own"), text), model, text).filter(F.col("lang_pred") == F.col("__own"))
        limits = scored.groupBy("__own").agg(F.percentile_approx("cross_entropy", reject, 10_000).alias("limit")).collect()
        for r in limits:
            model.limits[model.langs.index(r["__own"])] = r["limit"]
    return model


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` (bits per character) and ``rejected``.

    The whole text is scored.  A text that is null or has no letter gets ``und`` and score 0, and so does every text if
    nothing was learned.  Ties go to the first language by name.  Rejection marks a text and lowers its score; the
    nearest language is still named.  Rows are judged one by one, so repeated rows, long texts and empty tables need no
    care; columns named like the added ones are replaced and all others pass through.
    """
    bound_batches(docs.sparkSession)
    added = T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("cross_entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    docs = docs.drop(*added.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model  # its size is bounded by the sample that the fit reads
        known: dict[str, int] = {}
        scores, sizes, letters = np.zeros((0, len(m.langs))), np.zeros(0), np.zeros(0)
        for batch, texts in text_chunks(batches, text):
            split = [words_of((t or b"").decode("utf-8", "replace")) for t in texts]
            if len(known) > CACHE:
                known, scores, sizes, letters = {}, np.zeros((0, len(m.langs))), np.zeros(0), np.zeros(0)
            new = sorted({w for words in split for w in words} - known.keys())
            if new and m.langs:
                more, count = m.word_scores(new)
                known.update(zip(new, range(len(known), len(known) + len(new))))
                scores, letters = np.concatenate([scores, more]), np.concatenate([letters, count])
                sizes = np.concatenate([sizes, [len(w) + 1 for w in new]])
            n = len(texts)
            if m.langs:
                at = np.fromiter((known[w] for words in split for w in words), np.int64)
                row = np.repeat(np.arange(n), [len(w) for w in split])
                real = letters[at] > 0
                at, row = at[real], row[real]
                size = np.bincount(row, weights=sizes[at], minlength=n)
                entropy = -np.stack([np.bincount(row, weights=scores[at, i], minlength=n) for i in range(len(m.langs))], axis=1) / np.maximum(size, 1)[:, None]
                best = entropy.argmin(axis=1)
                least = entropy[np.arange(n), best]
                # Odds over the languages, as if of at most 40 characters, so that long texts stay apart in score.
                odds = np.exp2(-(entropy - least[:, None]) * np.minimum(size, 40)[:, None]).sum(axis=1)
                rejected = least > m.limits[best]
                score = np.where(rejected, m.limits[best] / np.maximum(least, 1e-9), 1.0) / odds
            else:
                size, best, least, rejected, score = np.zeros(n), np.zeros(n, int), np.zeros(n), np.zeros(n, bool), np.zeros(n)
            none = size == 0
            names = [UNKNOWN if x else m.langs[i] for x, i in zip(none, best)]
            columns = [
                pa.array(names, pa.string()), pa.array(np.where(none, 0.0, score)), pa.array(np.where(none, np.nan, least), from_pandas=True), pa.array(rejected & ~none)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added.fieldNames()])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))
