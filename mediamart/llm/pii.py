"""Operator 12, personal data (DataFrame functions only).

Every rule has a regular expression that proposes spans (leftmost, not
overlapping), a check that confirms them (Luhn, mod-97, number ranges, what
stands next to the span) and words that raise or lower its score when they
occur within CONTEXT characters before or after it, up to the rule's own
neighbouring proposals. The base rules (email, ip, card, phone) report every
confirmed span; the others (iban by mod-97 and the length of its country, ssn,
phone numbers without a country code) only from a score of REPORTED on.

A span's place is the length of all that the rule's splitting of the text puts
before it, so nothing is searched twice; running lengths are summed in parts
of PART proposals, which keeps texts with very many of them from taking time
by the square. The patterns are written so that an attempt starts only where
a run of its characters starts, and possessively, so no text takes time by the
square or recursion by its length. One scan, no shuffle.

Defined cases: a null text counts as empty and has no spans; texts are taken
whole, however long; a span that several rules of one kind report comes once,
with its best score; repeated rows, tied or null ids and other columns stay as
they are (the new column's name is the caller's); an empty table gives an
empty result. Offsets are code points from 0, the end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.llm.common import unused

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
CONTEXT, REPORTED, STEP, PART = 40, 0.5, 0.35, 128

# Characters of an IBAN by country.
IBAN_LENGTHS = """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29
ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20
LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27
ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"""


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    confirm: Callable[[Column, Column, Column], Column]      # (found, before, after) -> holds
    prior: float
    raising: str = ""
    lowering: str = ""
    base: bool = False
    needs: str = ""                                          # without it in the text there is no proposal
    end: Callable[[Column], Column] | None = None            # what of the proposal is the span


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _card(found, before, after):
    digits = _digits(found)
    return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


def _iban_part(found: Column) -> Column:
    """The first characters of the proposal, as many as its country has."""
    lengths = F.create_map(*[F.lit(x) for e in IBAN_LENGTHS.split() for x in (e[:2], int(e[2:]))])
    size = F.coalesce(F.try_element_at(lengths, F.substring(found, 1, 2)), F.lit(999))
    pattern = F.concat(F.lit("^(?:[A-Z0-9] ?){"), (size - 1).cast("string"), F.lit("}[A-Z0-9]"))
    return F.regexp_substr(found, pattern)


def _iban(found, before, after):
    part = _iban_part(found)
    letters = F.replace(part, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(letters, F.lit(5)), F.substring(letters, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""), F.lit(0).cast("long"),
        lambda acc, ch: (acc * F.when(ch >= "A", 100).otherwise(10) + F.conv(ch, 36, 10).cast("long")) % 97)
    tail = F.concat(F.substr(found, F.length(part) + 1), after)
    return F.coalesce(~before.rlike("[A-Za-z0-9]$") & ~tail.rlike("^[A-Za-z0-9]") & (rest == 1), F.lit(False))


RULES = (
    Rule("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda f, b, a: F.lit(True), 0.9, "mail|email|e-mail|contact|write", base=True, needs="@"),
    Rule("ip", r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}",
         lambda f, b, a: f.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), 0.6, "ip|host|server|address|from", "version|release|section", base=True),
    Rule("card", r"[0-9](?:[ -]?+[0-9])++", _card, 0.6, "card|visa|mastercard|amex|credit|debit|pay", "isbn|serial|order|tracking", base=True),
    Rule("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda f, b, a: F.length(_digits(f)).between(9, 15), 0.6,
         "tel|phone|call|fax|mobile|cell", base=True, needs="+"),
    Rule("phone", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
         lambda f, b, a: ~b.rlike(r"(?:[0-9]|[+][0-9 ().-]*)$") & ~a.rlike("^[0-9]"), 0.3,
         "tel|phone|call|fax|mobile|cell", "isbn|serial|order|tracking"),
    Rule("iban", r"[A-Z]{2}[0-9]{2}(?: ?+[A-Z0-9])++", _iban, 0.9, "iban|account|bank|transfer", end=_iban_part),
    Rule("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         lambda f, b, a: ~b.rlike("[0-9-]$") & ~a.rlike("^[0-9-]") & ~f.rlike("^(?:000|666|9)|-00-|-0000$"), 0.5,
         "ssn|social|security|taxpayer", "isbn|serial|order|invoice|part|ticket", needs="-"),
)


def _near(words: str, *sides: Column) -> Column:
    pattern = f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"
    hit = F.lit(False)
    for side in sides:
        hit = hit | side.rlike(pattern)
    return hit


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spans(rule: Rule, found: str, pieces: str, units: str, heads: str) -> Column:
    """The rule's confirmed spans: array of (start, place of the kind, end, kind, score, base)."""
    def one(i: Column) -> Column:
        text, before, after = F.get(found, i), F.get(pieces, i), F.get(pieces, i + 1)
        in_part = F.slice(units, (i - i % PART) + 1, i % PART + 1)
        start = F.get(heads, F.floor(i / PART).cast("int")) + F.aggregate(in_part, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.struct(start.alias("start"), text.alias("found"), F.right(before, F.lit(CONTEXT)).alias("before"),
                        F.left(after, F.lit(CONTEXT)).alias("after"))

    proposed = F.transform(F.sequence(F.lit(0), F.size(found) - 1), one)
    held = F.filter(proposed, lambda s: rule.confirm(s["found"], s["before"], s["after"]))

    def scored(s: Column) -> Column:
        sides = [F.translate(s[x], _UPPER, _LOWER) for x in ("before", "after")]
        score = F.lit(rule.prior)
        if rule.raising:
            score = score + F.when(_near(rule.raising, *sides), STEP).otherwise(0.0)
        if rule.lowering:
            score = score - F.when(_near(rule.lowering, *sides), STEP).otherwise(0.0)
        length = F.length(rule.end(s["found"]) if rule.end else s["found"])
        return F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(rule.kind)).alias("place"), (s["start"] + length).alias("end"),
            F.lit(rule.kind).alias("kind"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(score, 2))).alias("score"),
            F.lit(rule.base).alias("base"))

    spans = F.transform(held, scored)
    return spans if rule.base else F.filter(spans, lambda s: s["score"] >= REPORTED)


_SPAN = "array<struct<start:bigint,place:int,end:bigint,kind:string,score:double,base:boolean>>"


def find(docs: DataFrame, column: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with one more column: an array of (start, place, end, kind,
    score, base) by start, then kind. Each step is a projection of its own
    whose result the next one uses more than once, so none is repeated within
    a lambda."""
    tag = unused(docs, "_pii")
    keep = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    names = [f"{tag}{i}" for i in range(len(rules))]
    empty = F.array().cast("array<string>")

    def proposals(r: Rule) -> Column:
        every = F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0))
        return F.when(F.contains(text, F.lit(r.needs)), every).otherwise(empty) if r.needs else every

    at = docs.select(*keep, *[proposals(r).alias(f"{n}f") for n, r in zip(names, rules)])
    at = at.select("*", *[F.when(F.size(f"{n}f") > 0, F.split(text, r.pattern, -1)).otherwise(empty).alias(f"{n}p") for n, r in zip(names, rules)])
    at = at.select("*", *[F.zip_with(f"{n}p", F.concat(F.array(F.lit("")), F.col(f"{n}f")),
                                     lambda p, f: (F.length(p) + F.length(f)).cast("long")).alias(f"{n}u") for n in names])

    def part_sums(n: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(f"{n}u") / PART).cast("int")),
                           lambda b: F.aggregate(F.slice(f"{n}u", b * PART + 1, PART), F.lit(0).cast("long"), lambda a, x: a + x))

    def before_parts(n: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(f"{n}s") - 1),
                           lambda b: F.aggregate(F.slice(f"{n}s", F.lit(1), b), F.lit(0).cast("long"), lambda a, x: a + x))

    at = at.select("*", *[F.when(F.size(f"{n}f") > 0, part_sums(n)).alias(f"{n}s") for n in names])
    at = at.select("*", *[F.when(F.size(f"{n}f") > 0, before_parts(n)).alias(f"{n}h") for n in names])
    spans = [F.when(F.size(f"{n}h") > 0, _spans(r, f"{n}f", f"{n}p", f"{n}u", f"{n}h")).otherwise(F.array().cast(_SPAN))
             for n, r in zip(names, rules)]
    merged = at.select(*keep, F.array_sort(F.concat(*spans)).alias(column))
    # an equal span of the same kind comes once; its best-scored or base form sorts last
    kept = F.filter(F.col(column), lambda s, i: ~F.coalesce(
        (F.get(column, i + 1)["start"] == s["start"]) & (F.get(column, i + 1)["end"] == s["end"])
        & (F.get(column, i + 1)["place"] == s["place"]), F.lit(False)))
    return merged.withColumn(column, kept)


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every reported span of the text replaced by ``[KIND]``;
    spans that overlap are replaced once, by the first one's kind. A null text
    stays null."""
    column = unused(docs, "_spans")
    found = find(docs, column, text_col, rules)
    text = F.col(f"`{text_col}`")
    # (text so far in pieces, end of the last replaced span), pieces joined once
    cut = F.aggregate(
        column, F.struct(F.array().cast("array<struct<a:bigint,b:bigint,k:string>>").alias("out"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.when(s["start"] < acc["end"], F.struct(acc["out"].alias("out"), F.greatest(acc["end"], s["end"]).alias("end")))
        .otherwise(F.struct(F.concat(acc["out"], F.array(F.struct(acc["end"].alias("a"), s["start"].alias("b"), s["kind"].alias("k")))).alias("out"),
                            s["end"].alias("end"))))
    whole = F.concat(
        F.array_join(F.transform(cut["out"], lambda x: F.concat(
            F.substr(text, (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")), F.lit("["), F.upper(x["k"]), F.lit("]"))), ""),
        F.substr(text, (cut["end"] + 1).cast("int")))
    return found.select(*[whole.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
