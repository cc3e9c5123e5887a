"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust the score.

Only built-in expressions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankweave.llm.spans import after, before, cut, pieces, proposals

# What a span of each base kind looks like, in order of kind.
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
#   card   [0-9]([\x20-]?[0-9])+, 12 to 19 digits passing Luhn
#   phone  \+[0-9][\x20().0-9-]+[0-9], 9 to 15 digits
# They are written here so that the same spans are found in time linear in the text: a match may only start where a
# run of its first characters starts (or where the last match ended), and runs are not given back.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The method's own kinds.
# Where an IBAN may start; the match ends after the check digits, so one that is none hides none behind it.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])"
# Places of an IBAN by country, from the registry.  With other codes it may end at any place that a blank or the like follows.
IBAN_PLACES = {
    code: n for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items() for code in codes.split()}
IBAN_LEAST, IBAN_MOST = 15, 34


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without a match of this cheap expression has no span
    base_score: float
    context: str  # words that raise the score when they stand nearby
    least: float  # score a span needs


BASE = (
    Kind("email", EMAIL, "@", 0.9, "mail|e-mail|contact|kontakt|correo|courriel", 0.0),
    Kind("ip", IP, r"[0-9]\.[0-9]", 0.7, "ip|host|server|address|adresse", 0.0),
    Kind("card", CARD, r"[0-9][\x20-]?[0-9]", 0.7, "card|visa|karte|carte|tarjeta|credit|payment", 0.0),
    Kind("phone", PHONE, r"\+[0-9]", 0.7, "phone|tel|call|mobile|telefon|téléphone|teléfono|fax", 0.0),
)
MORE = (
    Kind("iban", IBAN, r"[A-Z]{2}[0-9]{2}", 0.9, "iban|account|konto|compte|cuenta|bank", 0.5),
    Kind("ssn", SSN, r"[0-9]{3}-[0-9]{2}-[0-9]", 0.3, "ssn|social|security", 0.5),
    Kind("local_phone", LOCAL_PHONE, r"[0-9]{3}[.-][0-9]{4}", 0.3, "phone|tel|call|mobile|telefon|téléphone|teléfono|fax", 0.5),
)
BONUS = 0.3
SPANS = "array<struct<start:int,order:int,kind:string,end:int,score:double>>"


def digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    value = lambda c, i: F.when(i % 2 == 0, c).otherwise(F.when(c > 4, c * 2 - 9).otherwise(c * 2))
    places = F.transform(F.split(F.reverse(number), ""), lambda c, i: value(c.cast("int"), i))
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks passes the mod-97 check: letters count 10 to 35, the first four places go last."""
    turned = F.concat(F.substring(iban, 5, 40), F.substring(iban, 1, 4))
    value = lambda c: F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda a, c: F.when(c == "", a).otherwise((a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def iban_at(run: Column) -> Column:
    """The IBAN that a text starts with, or null: as long as its country says, else the longest one that passes the check."""
    places = F.regexp_extract_all(run, F.lit(r"\G\x20?[A-Z0-9]"), F.lit(0))
    own = F.try_element_at(F.create_map(*[F.lit(x) for pair in IBAN_PLACES.items() for x in pair]), F.substring(run, 1, 2))
    lengths = F.when(own.isNotNull(), F.array(own)).otherwise(F.sequence(F.lit(IBAN_MOST), F.lit(IBAN_LEAST), F.lit(-1)))
    ends = F.transform(F.filter(lengths, lambda n: n <= F.size(places)), lambda n: F.array_join(F.slice(places, 1, n), ""))
    whole = lambda s: ~F.substring(run, F.char_length(s) + 1, F.lit(1)).rlike("[A-Za-z0-9]") & mod97(F.replace(s, F.lit(" "), F.lit("")))
    return F.get(F.filter(ends, whole), 0)


def apart(spans: Column) -> Column:
    """Spans in order of start, without those that an earlier one of them overlaps."""
    meet = F.exists(F.zip_with(spans, F.slice(spans, 2, F.size(spans)), lambda a, b: a["end"] > b["start"]), lambda x: F.coalesce(x, F.lit(False)))
    none = F.struct(F.lit(0).alias("end"), F.array().cast(SPANS).alias("kept"))
    kept = F.aggregate(spans, none, lambda acc, s: F.when(s["start"] < acc["end"], acc).otherwise(
        F.struct(s["end"].alias("end"), F.concat(acc["kept"], F.array(s)).alias("kept"))), lambda acc: acc["kept"])
    return F.when(meet, kept).otherwise(spans)


def confirmed(name: str, span: Column) -> Column:
    if name == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return span.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if name == "card":
        n = F.length(digits(span))
        return F.when(n.between(12, 19), luhn(digits(span))).otherwise(False)
    if name == "phone":
        return F.length(digits(span)).between(9, 15)
    if name == "iban":
        return span.isNotNull()
    if name == "ssn":
        return ~span.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def confirmed_spans(found: Column, held: Column, kind: Kind, order: int) -> Column:
    """Array of confirmed spans (start, order, kind, end, score) of one kind; ``held`` is the text in pieces."""
    if kind.name == "iban":
        found = F.transform(found, lambda p: p.withField("match", iban_at(cut(held, p["start"], 2 * IBAN_MOST))))
    near = rf"(?i)(?<!\p{{L}})(?:{kind.context})(?!\p{{L}})"
    end = lambda p: p["start"] + F.char_length(p["match"])
    scored = F.transform(F.filter(found, lambda p: confirmed(kind.name, p["match"])), lambda p: F.struct(
        p["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind.name).alias("kind"), end(p).alias("end"),
        F.least(F.lit(1.0), F.lit(kind.base_score) + F.when(before(held, p["start"]).rlike(near) | after(held, end(p)).rlike(near), BONUS).otherwise(0.0)).alias("score")))
    return F.filter(scored, lambda s: s["score"] >= kind.least) if kind.least else scored


def find_pii(docs: DataFrame, kinds: tuple[Kind, ...] = BASE + MORE, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: array of (start, order, kind, end, score), by start, then kind as listed.

    Positions count code points, ends are exclusive.  Spans of one kind do not overlap, those of different kinds
    may.  A null text counts as empty, and both give an empty array.  Rows are judged one by one, so repeated
    rows, long texts and empty tables need no care; a column named ``pii`` is replaced and all others pass through.
    """
    body = F.col("__text")
    held = docs.drop("pii").withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    # Each step reads the columns of the one before, so every expression runs over a text once or not at all.
    held = held.withColumns({
        f"__m{i}": F.when(body.contains(k.needs) if k.needs == "@" else body.rlike(k.needs), F.regexp_extract_all(body, F.lit(k.pattern), F.lit(0)))
        for i, k in enumerate(kinds)})
    held = held.withColumns({f"__p{i}": F.when(F.size(f"__m{i}") > 0, F.split(body, k.pattern, -1)) for i, k in enumerate(kinds)})
    found = F.array_max(F.array(*[F.size(f"__m{i}") for i in range(len(kinds))])) > 0
    held = held.withColumn("__c", F.when(found, pieces(body)))
    none = F.array().cast(SPANS)
    held = held.withColumns({
        f"__s{i}": F.when(F.col(f"__p{i}").isNotNull(), confirmed_spans(proposals(F.col(f"__m{i}"), F.col(f"__p{i}")), F.col("__c"), k, i)).otherwise(none)
        for i, k in enumerate(kinds)})
    every = F.array_sort(F.concat(*[apart(F.col(f"__s{i}")) if k.name == "iban" else F.col(f"__s{i}") for i, k in enumerate(kinds)]))
    return held.withColumn("pii", every).select(*[c for c in docs.columns if c != "pii"], "pii")


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
