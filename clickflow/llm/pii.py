"""Personal data: regular expressions propose spans, checks confirm them, context scores them.

A rule's pattern is matched leftmost and without overlap in the whole text. Its check, a
checksum or a range, drops a match or says where it ends. What is left gets the rule's score,
raised by words near it that speak for the kind and lowered by words that speak against it.
Spans of the base rules stay whatever their score; those of the other rules stay from
``LEAST_SCORE`` on and only where they do not overlap a base span.

Every pattern is tried at few places and gives nothing back once it has read a run, so that a text
of one long run of letters or digits is still read in linear time.
"""

import ipaddress
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.common import tidy

LEAST_SCORE = 0.5
# Words are looked for this many characters before and behind a match.
CONTEXT = 48
FOR, AGAINST = 0.35, -0.3

# Lengths of account numbers by country.
IBAN_LENGTHS = """
AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24
FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32
LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24
SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20
"""
_IBAN_LENGTH = {entry[:2]: int(entry[2:]) for entry in IBAN_LENGTHS.split()}


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """Whether an account number's two check digits fit it; letters count from 10 on."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _ip(match) -> int | None:
    small = all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split("."))
    return match.end() if small else None


def _card(match) -> int | None:
    # 19 digits have 18 gaps at most.
    digits = _digits(match[0]) if len(match[0]) <= 37 else ""
    return match.end() if 14 <= len(digits) <= 19 and luhn(digits) else None


def _phone(match) -> int | None:
    return match.end() if 10 <= len(_digits(match[0])) <= 15 else None


def _iban(match) -> int | None:
    """The end of an account number of its country's length, if nothing is joined to it."""
    wanted, text = _IBAN_LENGTH.get(match[0][:2], 0), match.string
    at, account = match.start(), ""
    while len(account) < wanted and at < match.end():
        account += text[at].strip()
        at += 1
    joined = text[at : at + 1].isalnum()
    return at if len(account) == wanted > 0 and not joined and mod_97(account) else None


def _ssn(match) -> int | None:
    area, group, serial = match[0].split("-")
    return match.end() if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000" else None


def _ipv6(match) -> int | None:
    after = match.string[match.end() : match.end() + 1]
    if after.isalnum() or after == ".":
        return None
    try:
        return match.end() if ipaddress.IPv6Address(match[0]) else None
    except ValueError:
        return None


@dataclass(frozen=True)
class Rule:
    """``within``: only runs that this pattern finds are searched. ``needs``: text without it is skipped."""

    kind: str
    pattern: str
    score: float
    check: Callable | None = None
    within: str | None = None
    needs: str | None = None
    speaks_for: str = ""
    against: str = "example|sample|dummy|placeholder"

    def matches(self, text: str) -> Iterator[tuple[int, int]]:
        """(start, end) of the matches that the check confirms."""
        if self.needs is not None and self.needs not in text:
            return
        pattern, check = re.compile(self.pattern, re.ASCII), self.check
        runs = [(0, len(text))] if self.within is None else (m.span() for m in re.finditer(self.within, text, re.ASCII))
        for low, high in runs:
            for match in pattern.finditer(text, low, high):
                end = check(match) if check else match.end()
                if end is not None:
                    yield match.start(), end

    def scored(self, text: str, start: int, end: int) -> float:
        around = f"{text[max(0, start - CONTEXT) : start]} {text[end : end + CONTEXT]}"
        score = self.score
        for words, change in ((self.speaks_for, FOR), (self.against, AGAINST)):
            if words and re.search(rf"(?<![a-z])(?:{words})(?![a-z])", around, re.IGNORECASE | re.ASCII):
                score += change
        return min(1.0, max(0.0, score))


@dataclass(frozen=True)
class Email(Rule):
    """A local part is tried where a run of its characters begins, and where the last match ended."""

    def matches(self, text: str) -> Iterator[tuple[int, int]]:
        if "@" not in text:
            return
        here = re.compile(self.pattern, re.ASCII)
        ahead = re.compile("(?<![A-Za-z0-9._%+-])" + self.pattern, re.ASCII)
        at = 0
        while match := here.match(text, at) or ahead.search(text, at):
            yield match.span()
            at = match.end()


BASE_RULES = (
    Email("email", r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.8, speaks_for="e-?mail|mail|contact|write"),
    Rule(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        0.5,
        _ip,
        within=r"[0-9][0-9.]*+",
        speaks_for="ip|host|server|address|from|login|client",
        against="version|release|licen[cs]ed?|section|example",
    ),
    Rule("card", r"[0-9](?:[\x20-]?[0-9])++", 0.7, _card, speaks_for="card|visa|mastercard|amex|credit|debit|cvv|payment"),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, _phone, needs="+", speaks_for="phone|tel|call|mobile|cell|fax|whatsapp|sms"),
)
# What the method adds. Without a checksum, a form that other numbers share needs context.
MORE_RULES = (
    Rule("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", 0.8, _iban, speaks_for="iban|account|bank|bic|swift"),
    Rule(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        0.3,
        _ssn,
        within=r"[0-9][0-9-]*+",
        speaks_for="ssn|social security|taxpayer|tin",
    ),
    Rule(
        "local_phone",
        r"(?:\([0-9]{3}\)\x20?|(?<![0-9().+-])[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
        0.3,
        within=r"[(0-9][\x20().0-9-]*+",
        speaks_for="phone|tel|call|mobile|cell|fax|whatsapp|sms",
    ),
    Rule("mac", r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}(?![0-9A-Fa-f:])", 0.6, within=r"[0-9A-Fa-f:]{17,}+", needs=":", speaks_for="mac|device|hardware|wifi|bluetooth"),
    Rule("ipv6", r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?!:)", 0.6, _ipv6, within=r"[0-9A-Fa-f:]{15,}+", needs=":", speaks_for="ip|ipv6|host|server|address|login"),
)
RULES = BASE_RULES + MORE_RULES


def spans_of(text: str, rules=RULES, base: int = len(BASE_RULES), least: float = LEAST_SCORE) -> list[tuple[int, int, int, float]]:
    """(start, rule's place, end, score) of a text's spans, by start, then rule.

    The first ``base`` rules are the base rules. Positions are code points, ends exclusive.
    """
    kept: list = []
    for order, rule in enumerate(rules[:base]):
        kept += [(start, order, end, rule.scored(text, start, end)) for start, end in rule.matches(text)]
    taken = sorted((start, end) for start, _, end, _ in kept)
    starts = [start for start, _ in taken]
    reach: list = []  # how far the spans up to each one go
    for _, end in taken:
        reach.append(max(end, reach[-1] if reach else 0))
    for order, rule in enumerate(rules[base:], base):
        for start, end in rule.matches(text):
            before = bisect_left(starts, end)
            if before and reach[before - 1] > start:
                continue
            score = rule.scored(text, start, end)
            if score >= least:
                kept.append((start, order, end, score))
    return sorted(kept)


_SPAN = pa.struct([("start", pa.int32()), ("rule", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
SPANS = T.ArrayType(
    T.StructType().add("start", T.IntegerType()).add("rule", T.IntegerType()).add("end", T.IntegerType()).add("score", T.DoubleType())
)


def _texts(column) -> Iterator[str]:
    """Texts of a column one by one; null is empty."""
    return (value.as_py() or "" for value in column)


def pii_spans(df: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """``key`` and ``__spans``, one row per row of ``df``; see ``spans_of``.

    A null text counts as empty and has no spans, an empty table gives an empty table, and
    repeated ids and rows are each searched. Other columns, whatever their names, are left out.
    """
    schema = df.select(key).schema.add("__spans", SPANS)

    def search(batches):
        for batch in batches:
            found = []
            for value in _texts(batch.column(1)):
                found.append([dict(zip(("start", "rule", "end", "score"), span)) for span in spans_of(value, rules, base)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(_SPAN))], [key, "__spans"])

    return df.select(key, text).mapInArrow(tidy(search), schema)


def mask_pii(df: DataFrame, text: str = "text", rules=RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """``df`` with every span in ``text`` replaced by its kind in brackets.

    Spans that overlap become one, named after the first. Texts without spans, null ones
    included, and all other columns stay as they are.
    """
    place = df.columns.index(text)

    def masked(value: str) -> str:
        parts, at = [], 0
        for start, order, end, _ in spans_of(value, rules, base):
            if start >= at:
                parts += [value[at:start], f"[{rules[order].kind}]"]
            at = max(at, end)
        return "".join([*parts, value[at:]])

    def replace(batches):
        for batch in batches:
            texts = [None if not t.is_valid else masked(t.as_py()) for t in batch.column(place)]
            columns = [*batch.columns]
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(tidy(replace), df.schema)


def span_text(spans: Column, rules=RULES) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    shown = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"], s["end"]))
    return F.array_join(shown, ",")


def span_count(spans: Column, order: int) -> Column:
    """How many spans are of the rule at place ``order`` of the rules."""
    return F.size(F.filter(spans, lambda s: s["rule"] == order)).cast("long")
