"""Registered queries of the corpus operators, each next to the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankweave.llm import alignment, langid, lines, mixing, ngrams, packing, pii, quality, secrets, topk, toxicity, urls, whitening
from bankweave.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary that the box offers; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if check is not None:
            ORACLES[name] = check
        return fn

    return register


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = quality.judge(docs.select("doc_id", "text"), quality.fit_references(docs))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op2_line_dedup", r"""
    WITH lines AS (
      SELECT doc_id, generate_subscripts(a, 1) AS pos, unnest(a) AS line FROM (
        SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN [''] ELSE string_split(text, chr(10)) END AS a FROM documents)),
    keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    hot AS (SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    marked AS (SELECT doc_id, pos, line, coalesce(keep <> doc_id, false) AS dropped FROM keyed LEFT JOIN hot USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op3_exact_topk", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5""")
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0)).drop("query_row")


_GLOB_SQL = "|".join(g.removesuffix("/**").replace("*", "[^/]*") + ("/.*" if g.endswith("/**") else "") for g in urls.BLOCKED)


@query("op4_url_filter", rf"""
    WITH u AS (SELECT page_id, translate(CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1) ELSE '' END,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
    r AS (SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
      regexp_full_match(host || path, '(?s:{_GLOB_SQL})') AS bad FROM u)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
      WHEN bad THEN 'block' ELSE 'allow' END AS verdict FROM r""")
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = langid.fit(docs.select("doc_id", "lang", "text"), ~held_out)
    found = langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    model = secrets.fit(secrets.labelled_findings(docs))
    return secrets.scan(docs, model, path="source").select("doc_id", "start", "end", "score", "is_secret")


@query("op8_mixing", """
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    n AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight,
      row_number() OVER (ORDER BY source NULLS LAST) AS n FROM s),
    c AS (SELECT *, 2 * source_size AS cap, 2 * source_size * (10 // weight) AS ratio, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights FROM n),
    p AS (SELECT *, coalesce(sum(cap) OVER w, 0) AS caps, coalesce(sum(weight) OVER w, 0) AS gone FROM c
      WINDOW w AS (ORDER BY ratio, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    f AS (SELECT *, cap * (weights - gone) * 2 >= (total * 3 - caps * 2) * weight AS free,
      (CAST(total * 3 AS DOUBLE) / 2 - CAST(caps AS DOUBLE)) / CAST(weights - gone AS DOUBLE) AS lv FROM p),
    g AS (SELECT *, CASE WHEN free THEN (SELECT arg_min(lv, (ratio, n)) FROM f WHERE free) * weight ELSE CAST(cap AS DOUBLE) END AS target FROM f),
    k AS (SELECT d.*, 's' || d.source AS s1, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) AS class,
      coalesce(substr(md5(CAST(doc_id AS VARCHAR)), 1, 3), '') AS slot FROM d),
    o AS (SELECT k.*, g.source_size, g.target, row_number() OVER (PARTITION BY k.source ORDER BY class, slot, size, doc_id) AS nth,
      CAST(CAST('0x' || substr(md5('mix|' || coalesce(s1, 'n')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE AS u,
      CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS r
      FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, size, source_size, target,
      CAST(size * least(floor(u + r * nth) - floor(u + r * (nth - 1)), 2) AS BIGINT) AS taken FROM o""")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sizes(mixing.parted(mixing.sized(read(spark, sf_dir, "documents")).select("doc_id", "source", "size")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op9_ngram_join", r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents),
    g AS (SELECT DISTINCT doc_id, md5(array_to_string(a[i : i + 4], ' ')) AS gram
      FROM (SELECT doc_id, a, unnest(range(1, greatest(len(a) - 4, 1) + 1)) AS i FROM w WHERE len(a) > 0)),
    s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
    c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
    p AS (SELECT a, b, c.n = sa.n AND c.n = sb.n AS same FROM c JOIN s sa ON a = sa.doc_id JOIN s sb ON b = sb.doc_id
      WHERE 5 * c.n >= 4 * (sa.n + sb.n - c.n)),
    r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.doc_id),
    k AS (SELECT doc_id, min(root) AS class_id FROM r GROUP BY 1)
    SELECT k.doc_id, class_id, count(p.a) AS n_links, 1 + count(p.a) FILTER (same) AS copies
    FROM k LEFT JOIN p ON p.a = k.doc_id GROUP BY k.doc_id, class_id""")
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngrams.ngram_join(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return joined.select("doc_id", "class_id", "n_links", "copies")


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("pii", lambda s: s["order"] < len(pii.BASE))

    def count(name: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    counts = [count(k.name) for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("pii")).alias("spans"))


@query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = alignment.align(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"), "n_shared")


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A deviation beyond the range of a long is null here; the operator gives 38 digits.
    return whitening.whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
