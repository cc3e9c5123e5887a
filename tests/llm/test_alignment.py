"""Tokenizer alignment against both tokenizer libraries and loops over bytes."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from bankweave.llm import alignment, queries
from bankweave.llm.common import read

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n string, a string"


def spans_of(tokens):
    end, out = 0, []
    for t in tokens:
        out.append((end, end + len(t)))
        end += len(t)
    return out


def by_hand(rows):
    """The query's rows and the counts by id pair, token by token."""
    a_library, b_library = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_library.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    out, totals = [], collections.Counter()
    for doc, text in rows:
        a_ids, b_ids, links, groups = [], [], [], []
        if text:
            a_ids, b_ids = a_library.encode(" " + text, add_special_tokens=False).ids, b_library.encode(text)
            a_bytes = [bytes(byte[c] for c in a_library.id_to_token(i)) for i in a_ids]
            b_bytes = []
            for i in b_ids:
                piece = b_library.id_to_piece(i)
                b_bytes.append(bytes([int(piece[3:5], 16)]) if b_library.is_byte(i) else piece.replace("▁", " ").encode())
            if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a_ids, b_ids, a_bytes, b_bytes = [], [], [], []
            a_spans, b_spans = spans_of(a_bytes), spans_of(b_bytes)
            j = 0
            for i, (low, high) in enumerate(a_spans):
                while b_spans[j][1] <= low:
                    j += 1
                k = j
                while k < len(b_spans) and b_spans[k][0] < high:
                    links.append((a_ids[i], b_ids[k]))
                    k += 1
            for end in sorted({e for _, e in a_spans} & {e for _, e in b_spans}):
                start = groups[-1][0] if groups else 0
                groups.append((end, [a_ids[i] for i, s in enumerate(a_spans) if start <= s[0] < end], [b_ids[i] for i, s in enumerate(b_spans) if start <= s[0] < end]))
        totals.update(links)
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for _, x, y in groups)
        shared = sum(len(x) * len(y) for _, x, y in groups)
        out.append([doc, len(a_ids), len(b_ids), len(groups), links, written, shared])
    top = collections.Counter()
    for (_, b), n in totals.items():
        top[b] = max(top[b], n)
    return collections.Counter(
        (doc, n_a, n_b, n_groups, len(links), sum(totals[x] == top[x[1]] for x in links), sum(totals[x] for x in links),
         hashlib.sha256(written.encode()).hexdigest() if n_a else "", shared) for doc, n_a, n_b, n_groups, links, written, shared in out)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "n_shared")
ODD = [
    (1, None), (2, ""), (3, " "), (4, "  two  blanks "), (5, "x"), (6, "the house <|endoftext|> and <s> </s> <0x41> <unk>"), (7, "lower▁one eighth"), (8, "ﬁ ligature and Ａ wide"),
    (9, "日本語のテキスト 🙂🙂 é é"), (10, "tabs\t\tand\nlines\r\n\x00\x01"), (11, " 　 odd spaces "), (12, "antidisestablishmentarianism " * 30), (None, "no id at all"), (12, "repeated"), (12, "repeated"),
    (13, "don't we'll THEY'RE 12345678901234567890"), (14, "a" * 5000), (15, "�﻿ bom"),
]


def test_odd_texts_in_one_slice_and_in_many(spark):
    rng = random.Random(5)
    rows = ODD + [(100 + i, "".join(rng.choices("abcde  \n.é日", k=rng.randint(0, 300)))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(4)
    want = by_hand(rows)
    for most in (alignment.MOST_PAIRS, 50):
        got = alignment.align(docs, A, B, most_pairs=most)
        assert collections.Counter(tuple(r[c] for c in COLUMNS) for r in got.collect()) == want
    text = {r["doc_id"]: r["groups"] for r in alignment.align(docs.filter("doc_id is not null and doc_id <> 12"), A, B, with_text=True).collect()}
    digests = {r[0]: r[7] for r in want}
    assert all((hashlib.sha256(t.encode()).hexdigest() if t else "") == digests[i] for i, t in text.items())


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, "x", "y")], SCHEMA)
    row = alignment.align(docs, A, B).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in row] == [(1, 0, 0, 0, 0, 0, 0, "", 0)]
    assert alignment.align(docs.limit(0), A, B).count() == 0


def test_products_against_dense_matrices():
    rng = np.random.default_rng(1)
    for _ in range(50):
        x, y = (rng.integers(0, 4, (rng.integers(1, 9), 7)) * (rng.random((1, 7)) < 0.5) for _ in range(2))

        def rows(m):
            i, j = np.nonzero(m)
            return alignment.Rows(np.concatenate([[0], np.cumsum(np.bincount(i, minlength=len(m)))]), j, m[i, j], m.shape[1])

        i, j, v = alignment.multiply(rows(x), alignment.transposed(rows(y)))
        dense = np.zeros((len(x), len(y)), int)
        dense[i, j] = v
        assert (dense == x @ y.T).all() and len(v) == np.count_nonzero(x @ y.T)


def test_blocks_of_bytes_lose_no_link():
    rng = np.random.default_rng(2)
    for _ in range(30):
        total = int(rng.integers(1, 200))
        a, b = (np.append(np.sort(rng.choice(np.arange(1, total), rng.integers(0, total), replace=False)) if total > 1 else [], total).astype(int) for _ in range(2))
        want = {(i, j): min(a[i], b[j]) - max(a[i - 1] if i else 0, b[j - 1] if j else 0) for i in range(len(a)) for j in range(len(b))}
        want = {k: v for k, v in want.items() if v > 0}
        for block in (1, 7, 1000):
            got = {(int(i), int(j)): int(v) for x in alignment.overlaps(a, b, block) for i, j, v in zip(*x)}
            assert got == want


def test_whole_table_against_loops(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, sf_dir, "documents").collect()]
    got = queries.queries()["op11_alignment"](spark, sf_dir).collect()
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared")
    assert collections.Counter(tuple(r[c] for c in names) for r in got) == by_hand(rows)
