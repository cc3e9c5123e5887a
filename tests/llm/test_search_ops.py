"""Top-k search, URL filter, n-gram join and the pipeline against brute force."""

import collections
import fnmatch
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bankweave.llm import components, ngrams, queries, topk, urls
from tests.compare import compare, duck
from tests.llm.test_text_ops import check_pieces, words


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, con, sf_dir, name):
    result = compare(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], sf_dir)
    assert result.startswith("ok"), result


# ---- top-k

def test_top_k_by_hand(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.1, 0.77]) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # a group of copies: ties
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [1.0, 2.0]), (305, []), (None, [0.5] * 6)]
    rows += [(50, rows[50][1]), (350, [3e14, -2e14, 1e13, 0.0, 1.0, 2.0]), (351, [3e14, -2e14, 1e13, 0.0, 1.0, 2.5])]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    got = topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), rows=16, groups=3).collect()
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = collections.Counter()
    for q, v in good:
        if q % 50 == 0:
            scores = sorted(((max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), c) for c, w in good if c != q and len(w) == len(v)), key=lambda x: (-x[0], x[1]))[:5]
            for rank, (s, c) in enumerate(scores, 1):
                want[q, rank, c, s] += 1
    assert collections.Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == want
    empty = vectors.limit(0)
    assert topk.top_k(empty, empty).count() == 0 and topk.top_k(vectors, empty).count() == 0


# ---- URLs

def test_automaton_against_regular_expressions():
    rng = random.Random(4)
    globs = ["a*b", "**", "", "a/**/b", "?b*", "ab" * 40, "*", "a**", "é?c", "**b", "*/*", "abc/*"]
    compiled = [re.compile("".join(".*" if x == "**" else "[^/]*" if x == "*" else "." if x == "?" else re.escape(x) for x in re.findall(r"\*\*|.", g)), re.S) for g in globs]
    texts = ["".join(rng.choices("ab/cé", k=rng.randint(0, 12))) for _ in range(3000)] + ["ab" * 40, "a" * 5000 + "b", ""]
    hits = urls.match(urls.compile_globs(globs), texts)
    for t, row in zip(texts, hits):
        assert list(row) == [bool(c.fullmatch(t)) for c in compiled], t
    assert fnmatch.fnmatch("ab", "a*")


def test_url_filter_edges(spark):
    rows = [
        ("https://a.example.net/en/1", "example.net/en/", "allow"), ("https://a.example.net/de/1", "net/", "block"), ("http://NET/x", "net/", "block"), ("http://x.net", None, "allow"),
        ("http://x.org/fr/", "org/fr/", "allow"), ("http://x.org/fr", None, "allow"), ("http://xorg/fr/", None, "allow"), (None, None, "allow"), ("no scheme.net/", None, "allow"), ("", None, "allow"),
        ("http://casino-win.example.com/en/", None, "block"), ("http://casino.example.com/de/1", "example.com/de/", "block"), ("http://a.com/b.net/x", None, "allow"), ("http://a.com?x=.net/", None, "allow"),
        ("http://a.com/casino", None, "allow"), ("ftp://h.org/fr/?q#f", "org/fr/", "allow"), ("http://a.net/" + "y" * 100_000, "net/", "block"), ("http://", None, "allow"), ("x://y://z.net/", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u, "clash") for i, (u, *_) in enumerate(rows * 2)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.filter_urls(pages).collect()}
    assert [got[i] for i in range(2 * len(rows))] == [(r, v) for _, r, v in rows * 2]
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_patterns_run_over_the_canonical_url(spark):
    rows = [
        ("http://c%61sino.com/x", "block"), ("http://CASINO.com.:8080/", "block"), ("http://spam-x@good.com/", "allow"), ("http://u:p@casino.example.fr/", "block"), ("http://casino@good.com", "allow"),
        ("http://good.com:80/a/../casino", "allow"), ("http://%63%41sino.co/", "block"), ("http://x@y@poker-a.com", "block"), ("http://good.com/%zz%", "allow"), ("http://[::1]:80/casino", "allow"), ("http://a.com..", "allow"),
    ]
    got = urls.filter_urls(spark.createDataFrame(list(enumerate(u for u, _ in rows)), "page_id long, url string")).collect()
    assert [r["verdict"] for r in sorted(got)] == [v for _, v in rows]
    assert sorted(got)[0]["host"] == "c%61sino.com" and sorted(got)[1]["host"] == "casino.com.:8080"
    assert urls.canonical("U@A.%42.c:1.", "/a/./b/../c/..") == ("a.b.c:1", "/a/")
    assert urls.canonical("", "") == ("", "") and urls.canonical("a:80", "/../../x/%2e%2e/y") == ("a", "/y") and urls.canonical("[::1]:443", "") == ("[::1]", "")
    assert urls.filter_urls(spark.createDataFrame([(1, "http://casino.com")], "page_id long, url string"), blocked=()).collect()[0]["verdict"] == "allow"


# ---- n-gram join

def links_by_hand(rows, n=5):
    sets = []
    for _, text in rows:
        w = (text or "").encode().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    links, parent = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            parent[max(top(a), top(b))] = min(top(a), top(b))
    members = collections.defaultdict(list)
    for i in range(len(rows)):
        members[top(i)].append(rows[i][0])
    low = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return [(rows[i][0], low[top(i)], links[i]) for i in range(len(rows))]


def near(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def corpus():
    rng = random.Random(6)
    vocabulary = tuple(f"w{i}" for i in range(3000))
    base = words(rng, 300, vocabulary)
    rows = [(i, near(rng, base, rng.randint(0, 9))) for i in range(150)]  # one large group of near copies
    rows += [(1000 + i, base) for i in range(60)] + [(2000 + i, words(rng, rng.randint(1, 200), vocabulary)) for i in range(80)]
    for i in range(40):
        t = words(rng, 120, vocabulary)
        rows += [(3000 + 2 * i, t), (3001 + 2 * i, near(rng, t, 2))]
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "a b"), (5004, "a  b"), (5005, "a b c"), (1000, base), (None, "only null id here today friends"), (5006, words(rng, 30_000, vocabulary))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("blocks", [(512, 1 << 20), (20, 1 << 20), (512, 4000)])
def test_ngram_join_by_hand(spark, blocks):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, class_id long").repartition(4)
    got = ngrams.ngram_join(docs, block_docs=blocks[0], block_ngrams=blocks[1]).collect()
    assert collections.Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == collections.Counter(links_by_hand(rows))
    lone = sum(not (t or "").split() for _, t in rows)
    assert sum(r["first"] for r in got) == len({r["class_id"] for r in got}) and lone == 3


def test_repeated_rows_come_to_a_cell_once(spark, monkeypatch):
    rng = random.Random(8)
    text, lone = words(rng, 80), words(rng, 90)
    rows = [(1, text)] * 60 + [(2, text + " one more")] + [(None, lone)] * 40 + [(3, lone + " one more"), (None, None), (4, None), (None, "")]
    seen, verify = [], ngrams.verify

    def watched(cells, *args):
        seen.extend(cells.groupBy("__leader", "__a", "__b", "__rid").count().collect())
        return verify(cells, *args)

    monkeypatch.setattr(ngrams, "verify", watched)
    got = collections.Counter((r["doc_id"], r["class_id"], r["n_links"], r["copies"]) for r in ngrams.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert seen and all(r["count"] == 1 for r in seen)
    assert got == collections.Counter({(1, 1, 60, 60): 60, (2, 1, 60, 1): 1, (None, 3, 40, 40): 40, (3, 3, 40, 1): 1, (None, None, 0, 1): 2, (4, 4, 0, 1): 1})


def test_ngram_join_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngrams.ngram_join(docs).count() == 0


def test_banding_reaches_recall():
    bands, rows = ngrams.banding(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= 80


def test_components_of_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (7000, 7000), (None, 5)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(201), 0), 1000: 1000, 1001: 1000, 7000: 7000}


# ---- pipeline

def test_pipeline_stages_by_hand(spark, tmp_path):
    rng = random.Random(8)
    shared = "this long line is shared by very many documents of the corpus"
    rows = [(i, words(rng, 120) + ("\n" + shared if i < 12 else ""), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "s0") for i in range(10)]  # copies
    rows += [(200, "too short", "en", "s1"), (201, None, None, None), (202, "again and again " * 100, "en", "s1")]
    path = str(tmp_path)
    spark.createDataFrame([(i, t, x, s, len(t or "")) for i, t, x, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    docs, at = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, path).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        at[name] = docs.collect()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda name: [r["doc_id"] for r in at[name]]
    assert set(ids("quality rules")) == {r[0] for r in rows} - {200, 201, 202}
    with_line = [r["doc_id"] for r in at["line dedup"] if shared in r["text"]]
    assert with_line == [109] and len(at["line dedup"]) == 70 and all(r["n_chars"] == len(r["text"]) for r in at["line dedup"])
    left = [(r["doc_id"], r["text"]) for r in at["line dedup"]]
    assert sorted(ids("n-gram Jaccard join")) == sorted({c for _, c, _ in links_by_hand(left)})
    copies = collections.Counter(ids("mixing sources"))
    assert max(copies.values()) <= 2 and set(copies) <= set(ids("n-gram Jaccard join"))
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    mixed = [(r["doc_id"], r["text"]) for r in at["mixing sources"]]
    tokens = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in mixed)
    assert sum(r["length"] for r in at["packing"]) == tokens
    once = [p for p in at["packing"] if copies[p["doc_id"]] == 1]
    assert {p["doc_id"] for p in at["packing"]} == set(copies) and once
    assert corpus_pipeline.run(spark, path).count() == len(at["packing"])


CORPUS = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """No documents at all, null ids, repeated rows and columns with the names that stages add."""
    rng = random.Random(9)
    rows = [(i, words(rng, 90), "en", "s0") for i in range(30)] + [(None, words(rng, 90), None, None)] * 20 + [(None, None, None, None), (3, "", "en", "s0"), (None, "", "xx", "s1")]
    rows += [(5, words(rng, 90), "en", "s0")] * 30
    clash = {c: "x" for c in ("size", "copies", "target", "kept", "n_words", "n_lines", "__own", "word", "length", "first", "source_size")}
    whole = spark.createDataFrame([(i, t, x, s, len(t or "")) for i, t, x, s in rows], CORPUS).withColumns({c: F.lit(v) for c, v in clash.items()})
    for k, docs in enumerate((whole, whole.limit(0))):
        for name, step in corpus_pipeline.STAGES:
            before = docs
            step(spark, docs, "").write.parquet(f"{tmp_path}/{k}{name}")
            docs = spark.read.parquet(f"{tmp_path}/{k}{name}")
            if name != "packing":
                assert docs.columns == before.columns
                assert docs.filter(" OR ".join(f"`{c}` <> 'x'" for c in clash)).count() == 0
            if k:
                assert docs.count() == 0
            elif name == "quality rules":
                assert docs.count() == len(rows) - 3
            elif name == "n-gram Jaccard join":
                left = docs.groupBy("doc_id").count().collect()
                assert {r["doc_id"] for r in left} == {*range(30), None} and max(r["count"] for r in left) == 2 and docs.count() == 32
    blank = corpus_pipeline.near_duplicates(spark, whole, "").filter("coalesce(text, '') = ''")
    assert blank.count() == 3  # documents without words all stay


def test_pieces_of_the_test_table(spark, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    pieces = queries.op5_packing(spark, sf_dir).collect()
    assert check_pieces(pieces, docs, lambda t: library.encode(t, add_special_tokens=False).ids) == 0


def test_rows_of_every_query(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op1_quality", "op6_language_id", "op9_ngram_join", "op10_pii"):
        df = queries.queries()[name](spark, sf_dir)
        assert df.select("doc_id").distinct().count() == n == df.count()
    assert np.isfinite(queries.op7_secret_scan(spark, sf_dir).agg(F.max("score")).collect()[0][0])
