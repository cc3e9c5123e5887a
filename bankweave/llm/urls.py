"""URL filter: glob rules packed into one bit-parallel automaton.

All patterns lie one behind the other in a row of 64-bit words, one bit for each position (Shift-And).  One step
over a character moves every bit one place, keeps the bits that the character's mask allows, and keeps bits in
front of a ``*`` where they are.  NumPy takes the step for a block of URLs at once, so every pattern is simulated
on every URL at the same time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankweave.llm.common import bound_batches

# (host and path, verdict): the rule holds for the host, its subdomains and paths that start so.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# Words in hosts of link spam, gambling, adult and malware sites.  ``*`` stays within a host or path segment, ``**`` does not.
WORDS = (
    "casino", "poker", "jackpot", "roulette", "blackjack", "baccarat", "slotmachine", "-slots", "slots-", "-bets", "bets-", "betting", "sportsbook", "bookmaker", "gambling", "bingo-", "-bingo",
    "lottery", "adult-", "-adult", "porn", "xxx", "xvideo", "escort", "hentai", "camgirl", "livesex", "sexcam", "nsfw", "milf", "viagra", "cialis", "levitra", "tramadol", "-pharmacy", "pharmacy-",
    "weightloss", "payday-loan", "paydayloan", "quick-loans", "spam-", "-spam", "linkfarm", "seo-links", "backlinks", "buy-followers", "malware", "phishing", "keylogger", "ransomware",
    "warez", "-crack", "crackz", "keygen", "torrentz", "nulled-", "essay-writing", "replica-watch", "fakeid-", "free-iphone", "crypto-giveaway",
)
BLOCKED = tuple(f"*{word}*{rest}" for word in WORDS for rest in ("", "/**"))
_START = 0x110000  # stands before the first character of every URL
_BLOCK = 1 << 20


@dataclass
class Automaton:
    alphabet: np.ndarray  # code points that some pattern names, sorted
    masks: np.ndarray  # by character class (the last one: any other character) and word
    slash: int  # class of "/", or -1
    stay: np.ndarray  # bits in front of "**"
    stay_in: np.ndarray  # bits in front of "*"
    first: np.ndarray  # first bits of the patterns
    last: list[tuple[int, int]]  # word and bit of the last place of each pattern


def compile_globs(globs: Sequence[str]) -> Automaton:
    """Automaton for patterns with ``?`` (one character), ``*`` (any within a segment) and ``**`` (any)."""
    places: list[int] = []  # code point, _START, or -1 for any
    stay: list[int] = []
    stay_in: list[int] = []
    first, last = [], []
    for glob in globs:
        first.append(len(places))
        places.append(_START)
        i = 0
        while i < len(glob):
            if glob.startswith("**", i):
                stay.append(len(places) - 1)
                i += 2
            elif glob[i] == "*":
                stay_in.append(len(places) - 1)
                i += 1
            else:
                places.append(-1 if glob[i] == "?" else ord(glob[i]))
                i += 1
        last.append(len(places) - 1)
    n = max(1, -(-len(places) // 64))
    alphabet = np.array(sorted({p for p in places if p >= 0} | {ord("/"), _START}), np.int64)

    def bits(at: Sequence[int]) -> np.ndarray:
        out = np.zeros(n, np.uint64)
        for p in at:
            out[p // 64] |= np.uint64(1 << (p % 64))
        return out

    named = {int(c): [i for i, p in enumerate(places) if p == c or (p == -1 and c != _START)] for c in alphabet}
    masks = np.stack([*[bits(named[int(c)]) for c in alphabet], bits([i for i, p in enumerate(places) if p == -1])])
    return Automaton(
        alphabet, masks, int(np.searchsorted(alphabet, ord("/"))), bits(stay), bits(stay_in), bits(first), [(p // 64, p % 64) for p in last])


def match(automaton: Automaton, texts: Sequence[str]) -> np.ndarray:
    """For every text and pattern: whether the pattern fits the whole text."""
    hits = np.zeros((len(texts), len(automaton.last)), bool)
    if not automaton.last:
        return hits
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    start = 0
    while start < len(order):  # texts of about the same length go together, a bounded number of characters at a time
        stop = start + 1
        while stop < len(order) and (stop - start + 1) * (len(texts[order[stop]]) + 1) <= _BLOCK:
            stop += 1
        rows = order[start:stop]
        hits[rows] = _run(automaton, [texts[i] for i in rows])
        start = stop
    return hits


def _run(a: Automaton, texts: list[str]) -> np.ndarray:
    lengths = np.array([len(t) for t in texts])
    codes = np.full((len(texts), lengths.max() + 1), -1, np.int64)
    codes[:, 0] = _START
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)
    codes[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1] = flat
    at = np.minimum(np.searchsorted(a.alphabet, codes), len(a.alphabet) - 1)
    kind = np.where(a.alphabet[at] == codes, at, len(a.alphabet))
    state = np.zeros((len(texts), a.masks.shape[1]), np.uint64)
    one, top = np.uint64(1), np.uint64(63)
    for t in range(codes.shape[1]):
        live = lengths >= t  # sorted by length: a suffix of the rows
        lo = len(texts) - int(live.sum())
        d, k = state[lo:], kind[lo:, t]
        moved = d << one
        moved[:, 1:] |= d[:, :-1] >> top
        moved &= ~a.first
        if t == 0:
            moved |= a.first
        held = d & (a.stay | np.where((k == a.slash)[:, None], np.uint64(0), a.stay_in))
        state[lo:] = (moved & a.masks[k]) | held
    return np.stack([(state[:, w] >> np.uint64(b)) & one == one for w, b in a.last], axis=1)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"^([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def canonical(host: str, path: str) -> tuple[str, str]:
    """Host and path as a browser would resolve them: without user part, port and last dots, with escapes undone and dot segments
    taken away; the host in lower case."""
    host = _unescape(host.rpartition("@")[2])
    name, colon, port = host.rpartition(":")
    if colon and all(c in "0123456789" for c in port):  # as far as it is no part of a bracketed address
        host = name
    segments: list[str] = []
    parts = _unescape(path).split("/")
    for i, part in enumerate(parts):
        if part in (".", ".."):
            if part == ".." and len(segments) > 1:
                segments.pop()
            if i == len(parts) - 1:
                segments.append("")
        else:
            segments.append(part)
    return host.rstrip(".").lower(), "/".join(segments)


def _unescape(text: str) -> str:
    return unquote(text, errors="replace") if "%" in text else text


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, blocked: Sequence[str] = BLOCKED, url: str = "url",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``blocked_by``.

    Of the rules that fit, the longest decides (of equal ones, the first listed).  If none fits, a URL whose canonical form fits a
    pattern of ``blocked`` is blocked and any other allowed.  Rules run over host and path as they stand, the patterns over
    the canonical ones (``canonical``), all rules and all patterns at once in an automaton each.  A URL that is null or has no ``://`` has an empty host and path, fits nothing and is allowed.  Rows
    are judged one by one, so repeated rows, an empty table and long URLs need no care; columns of ``pages`` named
    like the added ones are replaced.
    """
    fits = compile_globs([g for rule, _ in rules for g in (f"{rule}**", f"*.{rule}**")])
    bad = compile_globs(blocked)
    order = sorted(range(len(rules)), key=lambda i: (len(rules[i][0]), -i))  # the last fitting one in this order decides
    names, verdicts = [r for r, _ in rules], [v for _, v in rules]
    added = ["host", "path", "rule", "verdict", "blocked_by"]
    host, path = host_path(F.col(url))
    bound_batches(pages.sparkSession)
    rest = [c for c in pages.columns if c not in added]
    judged = pages.select(*rest).withColumns({"host": host, "path": path})
    schema = T.StructType([*judged.schema.fields, *[T.StructField(c, T.StringType()) for c in added[2:]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            hits = match(fits, [h + p for h, p in zip(hosts, paths)])
            own = match(bad, ["".join(canonical(h, p)) for h, p in zip(hosts, paths)])
            winner = np.full(len(hosts), -1)
            for i in order:
                winner[hits[:, 2 * i] | hits[:, 2 * i + 1]] = i
            found = np.where(own.any(axis=1), own.argmax(axis=1), -1) if own.shape[1] else np.full(len(hosts), -1)
            rule = [names[w] if w >= 0 else None for w in winner]
            verdict = [verdicts[w] if w >= 0 else "block" if f >= 0 else "allow" for w, f in zip(winner, found)]
            by = [blocked[f] if f >= 0 else None for f in found]
            extra = [pa.array(x, pa.string()) for x in (rule, verdict, by)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *added[2:]])

    return judged.mapInArrow(run, schema)
