"""Personal data: expressions propose spans, checksums confirm them, context
words adjust their score. DataFrame operations only.

Positions come without a loop over matches: ``split`` gives the text between
matches and ``regexp_extract_all`` the matches, and one fold over both adds up
their lengths (code points). Each expression is written so that Java's engine
neither rescans a run of characters nor recurses: a match can only start where
a run starts or where the last match ended, and inner repeats are possessive.
Account numbers are matched by their first four characters and look ahead at
the groups behind them, as those may hold other words or the next number.

Defined cases: a null text counts as empty (no spans, digest of the empty
string); very long texts are searched whole; equal rows give equal results; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import id_and_text

NEAR = 48       # code points of context on either side
LEAST = 0.5     # a span's least score
SPAN = "array<struct<start:int,kind:int,stop:int,score:double>>"


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    return F.length(digits(m)).between(12, 19) & F.call_function("luhn_check", digits(m))


def mod97(m: Column) -> Column:
    """The ISO 7064 check of an account number: its letters count 10 to 35, its
    first four characters stand last, and the remainder by 97 is 1."""
    flat = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(flat, 5, 64), F.substring(flat, 1, 4))
    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    rest = F.aggregate(chars, F.lit(0), lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))
    return F.length(flat).between(15, 34) & (rest == 1)


# characters of the account numbers of a country (ISO 13616)
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def account(m: Column) -> Column:
    """The account number that ``m`` starts with, null without one: of the
    beginnings that end with a group and pass mod-97, the one of the country's
    length, else the longest."""
    country = F.left(m, F.lit(2))
    length = F.lit(None).cast("int")
    for n, names in ACCOUNT_LENGTHS.items():
        length = F.when(country.isin(*names.split()), n).otherwise(length)

    def best(valid: Column) -> Column:
        own = F.filter(valid, lambda p: F.length(F.regexp_replace(p, " ", "")) == length)
        return F.coalesce(F.get(own, F.lit(0)), F.get(F.reverse(valid), F.lit(0)))

    return let(F.split(m, " "), lambda parts: best(F.filter(
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), " ")),
        mod97)))


@dataclass(frozen=True)
class Kind:
    """``score`` without context words nearby, ``score`` + 0.3 with them."""
    name: str
    pattern: str
    holds: str          # a cheap test: texts without it have no match
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = False
    ahead: bool = False     # groups 1 and 2 look ahead: the rest of a match, context behind it


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", lambda m: F.lit(True), 0.7, "mail|contact|write|reach", True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".",
         lambda m: m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"), 0.6, "ip|host|server|addr|ping", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", luhn, 0.7, "card|visa|master|amex|pay|credit", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+",
         lambda m: F.length(digits(m)).between(9, 15), 0.6, "phone|tel|call|mobile|fax", True),
    # one character more than the longest number has, to see whether its last group ends
    Kind("iban", rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?=((?:\x20?[A-Z0-9]){{11,31}}+)((?s:.{{0,{NEAR}}})))", "",
         account, 0.7, "iban|account|bank|konto|compte", ahead=True),
    # no checksum: only context words make it a span
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", lambda m: F.lit(True), 0.3,
         "ssn|social|security|tax"),
)


def let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def proposed(text: Column, at: int, kind: Kind) -> Column:
    """The valid spans of one kind as an array of SPAN structs."""
    none = F.array().cast(SPAN)

    def fold(pieces: Column, matches: Column) -> Column:
        n = F.size(matches)
        rows = F.zip_with(F.zip_with(F.slice(pieces, 1, n), matches,
                                     lambda before, m: F.struct(before.alias("before"), m.alias("m"))),
                          F.slice(pieces, 2, n),
                          lambda x, after: F.struct(x["before"].alias("before"), x["m"].alias("m"),
                                                    after.alias("after")))

        def add(acc: Column, x: Column) -> Column:
            start = acc["pos"] + F.length(x["before"])
            stop = start + F.length(x["m"])
            near = F.lower(F.concat(F.right(x["before"], F.lit(NEAR)), F.lit(" "), F.left(x["after"], F.lit(NEAR))))
            score = F.lit(kind.score) + F.when(near.rlike(kind.context), 0.3).otherwise(0.0)
            span = F.struct(start.alias("start"), F.lit(at).alias("kind"), stop.alias("stop"),
                            score.alias("score"))
            good = kind.valid(x["m"]) & (score >= LEAST)
            return F.struct(stop.alias("pos"),
                            F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

        return F.aggregate(rows, F.struct(F.lit(0).alias("pos"), none.alias("out")), add)["out"]

    def fold_ahead(pieces: Column, matches: Column) -> Column:
        """``m`` is what a match and its look ahead hold; of spans that overlap the first stays."""
        rest, behind = (F.regexp_extract_all(text, rx, F.lit(i)) for i in (1, 2))
        rows = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("before"), matches.alias("head"),
                            rest.alias("rest"), behind.alias("behind"))

        def add(acc: Column, x: Column) -> Column:
            start = acc["pos"] + F.length(x["before"])
            whole = F.concat(x["head"], x["rest"])

            def span(m: Column) -> Column:
                after = F.concat(F.substr(whole, F.length(m) + 1), x["behind"])
                near = F.lower(F.concat(F.right(x["before"], F.lit(NEAR)), F.lit(" "), F.left(after, F.lit(NEAR))))
                score = F.lit(kind.score) + F.when(near.rlike(kind.context), 0.3).otherwise(0.0)
                return F.struct(start.alias("start"), F.lit(at).alias("kind"),
                                (start + F.length(m)).alias("stop"), score.alias("score"))

            new = F.when(start < acc["end"], none).otherwise(F.transform(
                F.filter(F.array(kind.valid(whole)), lambda m: m.isNotNull()), span))
            return F.struct((start + F.length(x["head"])).alias("pos"),
                            F.greatest(acc["end"], F.get(new["stop"], F.lit(0))).alias("end"),
                            F.concat(acc["out"], F.filter(new, lambda s: s["score"] >= LEAST)).alias("out"))

        return F.aggregate(rows, F.struct(F.lit(0).alias("pos"), F.lit(0).alias("end"), none.alias("out")), add)["out"]

    rx = F.lit(kind.pattern)
    found = let(F.split(text, kind.pattern, -1), lambda pieces: F.when(F.size(pieces) <= 1, none).otherwise(
        let(F.regexp_extract_all(text, rx, F.lit(0)), lambda matches: (fold_ahead if kind.ahead else fold)(pieces, matches))))
    return F.when(F.contains(text, F.lit(kind.holds)), found).otherwise(none) if kind.holds else found


def find_pii(docs: DataFrame, kinds=KINDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): ``found`` is the array of all spans by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    every = F.concat(*(proposed(text, i, k) for i, k in enumerate(kinds)))
    return id_and_text(docs, id_col, text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.array_sort(every).alias("found"))


def joined(found: Column, kinds=KINDS) -> Column:
    names = F.array(*(F.lit(k.name) for k in kinds))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def n_of(found: Column, kind: int) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint")


def pii_report(docs: DataFrame, kinds=KINDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: spans of each base kind counted, a digest of the
    base spans, all spans, and their scores in the same order."""
    found = F.col("found")
    base = [i for i, k in enumerate(kinds) if k.base]
    own = F.filter(found, lambda s: s["kind"].isin(*base))
    return find_pii(docs, kinds, id_col, text_col).select(
        "doc_id",
        *(n_of(found, i).alias(f"n_{kinds[i].name}") for i in base),
        F.sha2(joined(own, kinds), 256).alias("base_sha256"), joined(found, kinds).alias("spans"),
        F.array_join(F.transform(found, lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))
