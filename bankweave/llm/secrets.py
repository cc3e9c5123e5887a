"""Secret scan: expressions propose candidates (long runs, and values that a word like "password" names), a random forest removes false positives.

The forest is trained from labelled findings on the candidate's length, its character transitions, how much of it
dictionary words cover, its path and the words around it.  Only built-in expressions and Spark ML are used.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankweave.llm.spans import after, before, pieces, proposals
from bankweave.session import stage

_PLACE = "A-Za-z0-9_+/-"
# At least 16 places with a digit among them; runs are not given back, so the search is linear in the text.
CANDIDATE = rf"(?<![{_PLACE}])(?=[A-Za-z_+/-]*+[0-9])[{_PLACE}]{{16,}}+={{0,2}}"
# Words that stand before secrets, and before other long tokens.
SECRET_WORDS = "token|secret|password|passwd|pwd|apikey|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret|auth|authorization|bearer|credential|credentials"
# What a word of these gives its name to: from the word to the value, then the value, closed by its own quote or open.
_TO_VALUE = rf"(?<![A-Za-z0-9])(?i:{SECRET_WORDS})(?![A-Za-z0-9])[\"'`\])]{{0,3}}(?:\s{{0,3}}(?:[:=]{{1,2}}>?|\bis\b)\s{{0,3}}|\s{{1,3}}(?=[\"'`])|(?<=[Bb]earer|BEARER)\s{{1,3}})"
ASSIGNED = rf"{_TO_VALUE}(?:\"[^\s\"]{{8,}}+(?=\")|'[^\s']{{8,}}+(?=')|`[^\s`]{{8,}}+(?=`)|[\"'`]?[^\s\"'`]{{7,}}[^\s\"'`.,;:)\]}}>])"
_IN_FRONT = rf"^{_TO_VALUE}[\"'`]?"
OTHER_WORDS = "commit|sha1|sha256|md5|checksum|digest|hash|etag|uuid|guid|revision|rev|build|version|integrity|session|trace|request|id|image|file|url|path|example|placeholder|dummy"
DUMMY_PATHS = "test|tests|fixture|fixtures|example|examples|sample|samples|mock|docs|doc"
# Words that identifiers, file names and placeholders are made of.
DICTIONARY = (
    "able", "about", "access", "account", "action", "active", "address", "admin", "after", "agent", "alert", "array", "asset", "async", "backup", "base", "batch", "before", "block", "board", "branch", "browser",
    "buffer", "build", "button", "cache", "call", "card", "center", "change", "check", "class", "client", "cloud", "code", "color", "column", "commit", "common", "component", "config", "connect", "content",
    "control", "count", "create", "credential", "current", "data", "date", "debug", "default", "delete", "demo", "device", "docs", "domain", "driver", "dummy", "email", "enable", "error", "event", "example", "export",
    "factory", "field", "file", "filter", "first", "form", "from", "function", "global", "group", "handler", "hash", "header", "history", "home", "host", "html", "http", "https", "image", "import", "index", "init", "input",
    "insert", "instance", "internal", "item", "java", "just", "label", "last", "layer", "library", "limit", "link", "list", "load", "local", "login", "manager", "master", "match", "member", "message", "method", "mode", "model",
    "module", "name", "network", "next", "node", "null", "number", "object", "order", "output", "page", "param", "parent", "password", "path", "place", "plugin", "print", "product", "project", "public", "query", "random", "read", "release",
    "report", "request", "required", "resource", "response", "result", "return", "sample", "schema", "script", "search", "secret", "server", "service", "session", "setting", "shared", "sign", "simple", "source", "start", "state", "static",
    "status", "storage", "store", "string", "style", "system", "table", "target", "task", "test", "text", "that", "their", "there", "this", "time", "title", "token", "type", "update", "user", "value", "version",
    "view", "with", "word", "world", "your", "xxxx", "1234", "0000",
)
FEATURES = (
    "length", "digit_share", "upper_share", "lower_share", "symbol_share", "vowel_share", "distinct_share", "switches", "letter_switches", "longest_letters",
    "longest_repeat", "brackets", "hex", "uuid", "padded", "dictionary", "path_dummy", "slashes", "word_secret", "word_secret_near", "word_other", "assigned", "quoted", "in_url",
)
MAX_FINDINGS = 40_000
TREES, DEPTH = 40, 8
SPREAD = 32  # partitions of the bounded sample, which a limit leaves in one
LIMIT = 0.5


def candidates(docs: DataFrame, doc: str = "doc_id", text: str = "text", path: str | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per candidate: ``doc_id``, ``start`` and ``end`` (code points, end exclusive), the token and its surroundings."""
    body = F.col("__text")
    held = docs.select(F.col(doc).alias("doc_id"), *extra, (F.col(path) if path else F.lit(None)).cast("string").alias("path"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    found = {i: F.when(body.rlike(x), F.regexp_extract_all(body, F.lit(x), F.lit(0))) for i, x in enumerate((CANDIDATE, ASSIGNED))}
    held = held.withColumns({f"__m{i}": x for i, x in found.items()}).filter((F.size("__m0") > 0) | (F.size("__m1") > 0))
    held = held.withColumns({
        "__p0": F.when(F.size("__m0") > 0, F.split(body, CANDIDATE, -1)), "__p1": F.when(F.size("__m1") > 0, F.split(body, ASSIGNED, -1)), "__c": pieces(body)}).drop("__text")
    runs, values = (F.when(F.col(f"__p{i}").isNotNull(), proposals(F.col(f"__m{i}"), F.col(f"__p{i}"))) for i in (0, 1))
    values = F.transform(values, lambda p: F.struct(
        (p["start"] + F.char_length(F.regexp_extract(p["match"], _IN_FRONT, 0))).alias("start"), F.regexp_replace(p["match"], _IN_FRONT, "").alias("match")))
    none = F.array().cast("array<struct<start:int,match:string>>")
    held = held.withColumn("__s", F.array_sort(F.concat(F.coalesce(runs, none), F.coalesce(values, none))))
    # A span that both expressions propose counts once.
    once = F.filter("__s", lambda p, i: (i == 0) | (F.get("__s", i - 1) != p))
    spans = F.transform(once, lambda p: p.withField("end", p["start"] + F.char_length(p["match"])))
    around = F.transform(spans, lambda p: p.withField("before", before(F.col("__c"), p["start"])).withField("after", after(F.col("__c"), p["end"])))
    # The outer form: no filter on the spans is then moved below, where it would find them anew from the text.
    found = held.withColumn("__f", around).select("doc_id", *extra, "path", F.explode_outer("__f").alias("f"))
    return found.select(
        "doc_id", *extra, "path", F.col("f.start").cast("long").alias("start"), F.col("f.end").cast("long").alias("end"),
        F.col("f.match").alias("token"), F.col("f.before").alias("before"), F.col("f.after").alias("after"))


def features(found: DataFrame) -> DataFrame:
    """``found`` with the columns of ``FEATURES``; all are defined for every candidate."""
    token, before, n = F.col("token"), F.lower("before"), F.char_length("token")
    share = lambda expression: F.regexp_count(token, F.lit(expression)) / n
    longest = lambda values: F.coalesce(F.array_max(F.transform(values, F.char_length)), F.lit(0))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    word = lambda words, tail: rf"(?<![a-z0-9])(?:{words}){tail}"
    values: dict[str, Column] = {
        "length": n,
        "digit_share": share("[0-9]"), "upper_share": share("[A-Z]"), "lower_share": share("[a-z]"), "symbol_share": share("[^A-Za-z0-9]"),
        "vowel_share": share("[aeiouAEIOU]"), "distinct_share": F.size(F.array_distinct(F.split(token, ""))) / n,
        "switches": share("(?<=[a-z])[A-Z]|(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"),
        "letter_switches": share("(?<=[aeiou])[b-df-hj-np-tv-z]|(?<=[b-df-hj-np-tv-z])[aeiou]"),
        "longest_letters": longest(F.regexp_extract_all(token, F.lit("[A-Za-z]+"), F.lit(0))),
        "longest_repeat": longest(F.regexp_extract_all(token, F.lit(r"(.)\1+"), F.lit(0))),
        "brackets": share(r"[(){}\[\]<>]"),
        "hex": flag(token.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")), "uuid": flag(token.rlike("^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")),
        "padded": flag(token.endswith("=")),
        "dictionary": 1 - F.char_length(F.regexp_replace(F.lower(token), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")) / n,
        "path_dummy": flag(F.lower("path").rlike(rf"(?:^|[^a-z])(?:{DUMMY_PATHS})(?:$|[^a-z])")), "slashes": share("/") * n,
        "word_secret": flag(before.rlike(word(SECRET_WORDS, r"[\s\"'`]{0,3}[:=]?>?\s{0,2}[\"'`]?$"))), "word_secret_near": flag(before.rlike(word(SECRET_WORDS, r"(?![a-z0-9])"))),
        "word_other": flag(before.rlike(word(OTHER_WORDS, r"[\s\"'`(]{0,3}[:=@/#]?\s{0,2}[\"'`]?$"))), "assigned": flag(before.rlike(r"[:=]>?\s{0,2}[\"'`]?$")),
        "quoted": flag(before.rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")), "in_url": flag(before.rlike(r"(?:https?://|www\.)\S*$")),
    }
    return found.withColumns({k: v.cast("double") for k, v in values.items()})


def fit(findings: DataFrame, label: str = "label", most: int = MAX_FINDINGS, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> PipelineModel:
    """Forest from labelled findings (the columns of ``candidates`` and ``label`` 0 or 1; rows without label are left out).

    At most ``most`` findings are used, the ones with the smallest hashes; this bounds the fit alone.
    """
    known = findings.filter(F.col(label).isNotNull()).orderBy(F.xxhash64("token", "before"), "token", "before").limit(most).repartition(SPREAD)
    # The forest reads its rows many times; stored, they do not go back to the documents each time.
    rows = stage(features(known).select(F.col(label).cast("double").alias("label"), *FEATURES), "findings")
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt")
    return Pipeline(stages=[assembler, forest]).fit(rows)


def scan(docs: DataFrame, model: PipelineModel, limit: float = LIMIT, doc: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per candidate: ``doc_id``, ``start``, ``end``, ``token``, ``score`` and ``is_secret`` (score over ``limit``).

    ``path`` names a column that says where the text comes from, if there is one.  Null and empty texts have no
    candidates, an empty table gives no rows, repeated rows give their candidates again, and rows without id keep a
    null id.  Texts are read whole and row by row; other columns are left out.
    """
    scored = model.transform(features(candidates(docs, doc, text, path)))
    score = vector_to_array("probability")[1]
    return scored.select("doc_id", "start", "end", "token", F.round(score, 6).alias("score"), (score > limit).alias("is_secret"))


# How labelled findings are written: label, text in front of the token, token, text behind it, path.  {w} is a word of a document.
_HEX40, _HEX64, _HEX32 = "sha1(seed)", "sha2(seed, 256)", "md5(seed)"
_RANDOM = "replace(replace(base64(unhex(sha2(seed, 256))), '+', 'x'), '/', 'Q')"
_UUID = "concat_ws('-', substr(md5(seed), 1, 8), substr(md5(seed), 9, 4), substr(md5(seed), 13, 4), substr(md5(seed), 17, 4), substr(md5(seed), 21, 12))"
_SLUG = "concat(w1, '-', w2, '-', w3, '-', substr(md5(seed), 1, 2), '1')"
_WORDS = "concat(w1, w2, w3, substr(translate(md5(seed), '0123456789', 'ghijklmnop'), 1, 8))"  # letters alone
_MIXED = "concat(initcap(substr(w1, 1, 6)), substr(translate(md5(seed), 'abcdef', '012345'), 1, 2), element_at(array('!', '.', '&', '#', '@', '$', ':'), 1 + pmod(hash(seed), 7)), initcap(substr(w2, 1, 6)), substr(md5(seed), 3, 3))"
_SHORT = "concat(substr(replace(replace(base64(unhex(md5(seed))), '+', '.'), '/', '@'), 1, 9), element_at(array('!', '?', '-', '#', '%', '*'), 1 + pmod(hash(seed), 6)))"
_NAME = "concat('example_', w1, '_value_', w2, '_0001')"
TEMPLATES = (
    (1, '{w} token = "', _HEX40, '" {w}', "{s}"), (1, "{w} secret: ", _RANDOM, " {w}", "{s}"), (1, "{w} api_key='", _HEX32, "' {w}", "{s}"),
    (1, '{w} password = "', f"substr({_RANDOM}, 1, 20)", '" {w}', "{s}"), (1, "Authorization: Bearer ", _RANDOM, " {w}", "{s}"),
    (1, '{w} TOKEN: "', f"upper({_HEX40})", '", {w}', "{s}"), (1, '{w} access_key: "', f"upper(substr({_RANDOM}, 1, 20))", '" {w}', "src/main"),
    (1, '{w} client_secret="', _HEX64, '"', "src/config"),
    (1, '{w} password = "', _MIXED, '" {w}', "{s}"), (1, "{w} pwd: '", _SHORT, "' {w}", "{s}"), (1, '{w} secret = "', _WORDS, '" {w}', "{s}"), (1, "{w} passwd=", _MIXED, " {w}", "{s}"),
    (0, "{w} token = ", "concat('get_', w1, '(', w2, ')')", " {w}", "{s}"), (0, "{w} password: ", "concat('required_', w1)", " {w}", "{s}"), (0, "{w} auth: ", "concat('${', w1, '.', w2, '}')", " {w}", "{s}"),
    (0, '{w} password = "', "concat('<your-', w1, '>')", '" {w}', "{s}"), (0, '{w} secret = "', "'changeme_default'", '" {w}', "{s}"), (0, "{w} the secret is ", "concat(w1, w2)", ", {w}", "{s}"),
    (0, "{w} commit ", _HEX40, " {w}", "{s}"), (0, "{w} sha256: ", _HEX64, " {w}", "{s}"), (0, "{w} md5 = ", _HEX32, " {w}", "{s}"),
    (0, '{w} uuid = "', _UUID, '" {w}', "{s}"), (0, "{w} see https://www.example.com/", _SLUG, " {w}", "{s}"), (0, "{w} {w} ", _SLUG, " {w}", "{s}"),
    (0, '{w} password = "', _NAME, '" {w}', "docs/examples"), (0, "{w} id: ", _UUID, " {w}", "{s}"), (0, '{w} token = "', "concat('xxxxxxxxxxxxxxxx', '0000')", '" {w}', "tests/fixtures"),
    (0, "{w} checksum ", _HEX40, " {w}", "{s}"), (0, "{w} image ", _HEX64, " {w}", "{s}"), (0, "{w} {w} ", _HEX40, " {w}", "{s}"), (0, "{w} ", "concat(substr(w1, 1, 8), '-', substr(md5(seed), 1, 12))", " {w}", "{s}"),
)


def labelled_findings(docs: DataFrame, most: int = MAX_FINDINGS // len(TEMPLATES), doc: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Labelled findings derived from documents where no reviewed ones are at hand: tokens of known kind set among a document's words.

    At most ``most`` documents (by hash of the id) give one finding for each template.
    """
    words = F.split(F.col(text), r"[^\p{L}]+", 6)  # some of its first words are all that is used
    word = lambda i: F.coalesce(F.nullif(F.try_element_at(F.col("ws"), F.lit(i)), F.lit("")), F.lit("word"))
    base = (
        docs.filter(F.col(doc).isNotNull() & (F.char_length(text) > 0)).select(F.col(doc).alias("d"), F.col(source).cast("string").alias("s"), words.alias("ws"))
        .select("d", "s", word(2).alias("w1"), word(3).alias("w2"), word(4).alias("w3")).orderBy(F.xxhash64("d"), "d").limit(most).repartition(SPREAD))
    parts = [
        F.struct(F.lit(label).alias("label"), F.lit(front).alias("front"), F.expr(token.replace("seed", f"concat(d, '/{i}')")).alias("token"), F.lit(back).alias("back"), F.lit(path).alias("path"))
        for i, (label, front, token, back, path) in enumerate(TEMPLATES)]
    rows = base.withColumn("t", F.explode(F.array(*parts)))
    fill = lambda c: F.replace(F.replace(c, F.lit("{w}"), F.col("w1")), F.lit("{s}"), F.coalesce("s", F.lit("")))
    snippets = rows.select("d", F.col("t.label").alias("label"), F.concat(fill(F.col("t.front")), "t.token", fill(F.col("t.back"))).alias("snippet"), fill(F.col("t.path")).alias("where"))
    return candidates(snippets, "d", "snippet", "where", extra=("label",))
