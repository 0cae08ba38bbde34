"""PII spans: patterns propose, checksums confirm, context adjusts the score (operator 4). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import pick

# The kinds, in the order that breaks ties of the start; the first four are the base.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "secret")

# The base patterns, written so that the regex engine needs time in proportion to the text and no deep
# recursion on texts of any length: runs are possessive, a match can only begin where a run begins (or
# right after the last match), and repeated groups are single characters under a look-ahead.
_L = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_L}]))[{_L}]++@[A-Za-z0-9-]++\.(?=[A-Za-z0-9-])(?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # only runs of 14 digits or more: shorter ones fail the validator, and skipping them moves no other match
    "card": r"(?=[0-9](?:[ -]?[0-9]){13})[0-9](?:(?![ -](?![0-9]))[0-9 -])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # built from the lengths below
    "iban": "",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    # named keys, tokens by their issuers' prefixes, values after a telling word, bearer headers, private key blocks (runs are possessive)
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{20,}+|sk-[A-Za-z0-9_-]{16,}+|xox[abprs]-[A-Za-z0-9-]{10,}+"
              r"|(?i:bearer) [A-Za-z0-9_+/.=-]{12,}+|(?i:password|passwd)[ ]?[=:][ ]?[\"']?[A-Za-z0-9_+/.!@#$%^&*-]{6,}+"
              r"|(?i:token|secret|api_?key)[ ]?[=:][ ]?[\"']?[A-Za-z0-9_+/.-]{8,}+)|-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*+-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----)?",
}

# The length of an IBAN in each country that issues them, from the public registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban(length: int, countries: str) -> str:
    """Country, check digits and exactly the rest of the length, single spaces between groups of four allowed."""
    groups, rest = divmod(length - 4, 4)
    return rf"(?i:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Za-z0-9]{{4}}){{{groups}}}" + (rf" ?[A-Za-z0-9]{{{rest}}}" if rest else "")


# one alternative a length: what follows an account number can't become part of it
PATTERNS["iban"] = r"(?<![A-Za-z0-9])(?:" + "|".join(_iban(n, c) for n, c in IBAN_LENGTHS.items()) + r")(?![A-Za-z0-9])"

#: Score a kind starts with once its validator agrees, and the words near a span (either side) that raise it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "secret": 0.8}
CONTEXT = {
    "email": r"(?i)e-?mail|contact|write|mailto",
    "ip": r"(?i)\bip\b|address|host|server",
    "card": r"(?i)card|visa|credit|payment|amex",
    "phone": r"(?i)phone|call|\btel\b|mobile|fax",
    "iban": r"(?i)iban|account|bank|konto|transfer",
    "ssn": r"(?i)ssn|social security|tax",
    "secret": r"(?i)login|credential|secret|\bkey\b|authorization",
}
BOOST = 0.3
REACH = 40
#: Matches whose places are summed up in one go.
CHUNK = 256
#: Added kinds are kept from this score on; base spans are kept whatever their score.
THRESHOLD = 0.5

_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    n = F.length(d)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when(
        (n - i) % 2 == 0, F.substring(d, i, F.lit(1)).cast("int")).otherwise(
        F.substring(d, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(d, i, F.lit(1)).cast("int") > 4, 9).otherwise(0)))
    return total % 10 == 0


def mod97(x: Column) -> Column:
    """Whether an IBAN leaves 1 modulo 97 (first four characters moved to the end, letters of either case as 10 to 35)."""
    s = F.upper(F.regexp_replace(x, " ", ""))
    s = F.concat(F.substr(s, F.lit(5)), F.substring(s, 1, 4))
    rest = F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), lambda r, i: F.when(
        F.ascii(F.substring(s, i, F.lit(1))) >= 65, (r * 100 + F.ascii(F.substring(s, i, F.lit(1))) - 55) % 97).otherwise(
        (r * 10 + F.ascii(F.substring(s, i, F.lit(1))) - 48) % 97))
    return F.length(s).between(15, 34) & (rest == 1)


def confirmed(kind: str, m: Column) -> Column:
    """The kind's validator on the matched text."""
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255))
    if kind == "card":
        d = digits(m)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(m)).between(10, 15)
    if kind == "iban":
        return mod97(m)
    if kind == "ssn":
        return ~m.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _placed(steps: Column) -> Column:
    """Start and end of every match from the (gap, match) steps of a text.

    Running sums inside chunks of CHUNK steps, and over the chunks: appending
    to one array throughout would take time quadratic in the matches.
    """
    width = lambda s: s["g"] + F.length(s["m"])
    size = F.size(steps)
    chunks = F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1)), F.lit(CHUNK)), lambda i: F.slice(steps, i, CHUNK))
    begun = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,steps:array<struct<g:int,m:string>>>>").alias("out")),
                        lambda acc, c: F.struct((acc["at"] + F.aggregate(c, F.lit(0), lambda n, s: n + width(s))).alias("at"), F.concat(
                            acc["out"], F.array(F.struct(acc["at"].alias("at"), c.alias("steps")))).alias("out")))["out"]
    inside = lambda c: F.aggregate(c["steps"], F.struct(c["at"].alias("at"), F.array().cast("array<struct<m:string,start:int,end:int>>").alias("out")),
                                   lambda acc, s: F.struct((acc["at"] + width(s)).alias("at"), F.concat(acc["out"], F.array(F.struct(
                                       s["m"].alias("m"), (acc["at"] + s["g"]).alias("start"), (acc["at"] + width(s)).alias("end")))).alias("out")))["out"]
    return F.flatten(F.transform(begun, inside))


def _context_score(kind: str, text: Column, start: Column, end: Column) -> Column:
    before = F.substr(text, F.greatest(start - REACH, F.lit(0)) + 1, F.least(start, F.lit(REACH)))
    after = F.substr(text, end + 1, F.lit(REACH))
    near = F.concat(before, F.lit("\n"), after).rlike(CONTEXT[kind])
    return F.least(F.lit(1.0), F.lit(PRIOR[kind]) + F.when(near, BOOST).otherwise(0.0))


def _confirms(kind: str):
    return lambda s: confirmed(kind, s["m"])


def _scores(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                              _context_score(kind, F.col("text"), s["start"], s["end"]).alias("score"))


def pii_spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, spans`` (array of kind, start, end, score; code points, end exclusive).

    Matches are leftmost and don't overlap within a kind; a match that fails
    its validator is dropped without a second try inside it. Spans are sorted
    by start, then by the kind's place in KINDS. Every base span stays, with
    its score; of the added kinds those with a score of ``threshold`` or more.
    Null and empty texts have no spans; null doc_ids and repeated rows come
    out once each; an empty table gives an empty result; extra columns are
    ignored.
    """
    d = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    for k in KINDS:
        d = d.withColumn(f"m_{k}", F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0)))
    none = F.array().cast(_SPAN)
    for k in KINDS:
        # where the matches are: the gaps between them come from a split by the same pattern
        d = d.withColumn(f"g_{k}", F.when(F.size(f"m_{k}") > 0, F.transform(F.split("text", PATTERNS[k], -1), lambda g: F.length(g))))
    for k in KINDS:
        m, gap = F.col(f"m_{k}"), F.col(f"g_{k}")
        placed = _placed(F.zip_with(F.slice(gap, 1, F.size(m)), m, lambda g, x: F.struct(g.alias("g"), x.alias("m"))))
        d = d.withColumn(f"p_{k}", F.when(F.size(m) > 0, F.filter(placed, _confirms(k))))
    for k in KINDS:
        d = d.withColumn(f"s_{k}", F.coalesce(F.transform(f"p_{k}", _scores(k)), none))
    added = [F.filter(f"s_{k}", lambda s: s["score"] >= threshold) for k in KINDS[4:]]
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    every = F.transform(F.array_sort(F.transform(F.concat(*[F.col(f"s_{k}") for k in BASE], *added), lambda s: F.struct(
        s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["score"].alias("score")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
    return d.select("doc_id", every.alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, text`` with every span replaced by ``<KIND>``; overlapping spans merge to the furthest end under the first one's kind."""
    d = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    # doc_id may repeat, so the spans are found on the row itself, not joined back to it
    s = pii_spans(d.select(F.struct("doc_id", "text").alias("doc_id"), "text"), threshold).toDF("row", "spans")
    text, spans = F.col("row.text"), F.col("spans")
    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, x: F.when(
        x["start"] < acc["at"], F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(x["end"].alias("at"), F.concat(
            acc["out"], F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit("<"), F.upper(x["kind"]), F.lit(">")).alias("out"))))
    return s.select(F.col("row.doc_id").alias("doc_id"), F.concat(done["out"], F.substr(text, done["at"] + 1)).alias("text"))
