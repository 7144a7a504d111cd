"""Secret scans: a trigram inverted index finds candidates, regular expressions verify them.

Built-in functions only. Rules are (kind, pattern, group, least): the pattern is matched
leftmost and without overlap in the whole text, then matches whose group (0: the match)
has fewer than ``least`` characters are dropped.
"""

import re
from dataclasses import dataclass
from functools import reduce

try:  # the parser of Python's own regular expressions
    from re import _constants as tokens
    from re import _parser as parser
except ImportError:  # before Python 3.11
    import sre_constants as tokens
    import sre_parse as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import small_side


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    # A run that is too short has no longer match inside it, so the length is part of these.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# A private key runs to the next END marker. Every loop is over one ASCII character, so that
# Java's matcher needs no stack for it, and no other marker stands in between.
_PEM_BEGIN = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----"
_PEM_BODY = r"(?:(?!-----)[\x00-\x7f])*"
_PEM_END = r"-----END [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----"
# Without one it runs over header lines, then over white space (also written as \n) and runs of
# base64, of 16 characters at least, and a shorter last line. Prose after a marker stays.
_PEM_LINES = (
    r"(?:\s{1,9}(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset): [^\r\n]{0,100}){0,5}"
    r"(?:(?![\s\\](?![\s\\rn]{0,40}[A-Za-z0-9+/]{16}))[A-Za-z0-9+/=\s\\])*"
    r"""(?:(?<=[A-Za-z0-9+/]{16})(?:\r?\n|(?:\\r)?\\n)[A-Za-z0-9+/]{1,63}={0,2}(?![^\r\n"'\\]))?"""
)
# What the method adds: keys and tokens with a fixed prefix.
MORE_RULES = (
    Rule("pem", _PEM_BEGIN + rf"(?:{_PEM_BODY}{_PEM_END}|{_PEM_LINES})"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

# Sets of literal strings beyond this size say too little to be worth postings.
MOST_LITERALS = 64
# Trigrams to a word of a document's bit set.
BITS = 62


def _lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _literals(parsed) -> tuple[list[set[str]], set[str] | None]:
    """(conjunction of alternatives that a match must contain, all strings it can be or None)."""
    needed: list[set[str]] = []
    current: set[str] = {""}

    def close():
        if current and all(len(s) >= 3 for s in current):
            needed.append(set(current))

    exact = True
    for op, value in parsed:
        options: set[str] | None = None
        if op is tokens.LITERAL:
            options = {_lower(chr(value))}
        elif op is tokens.IN and value[0][0] is not tokens.NEGATE:
            chars: set[str] = set()
            for kind, item in value:
                if kind is tokens.LITERAL:
                    chars.add(_lower(chr(item)))
                elif kind is tokens.RANGE and item[1] - item[0] < 8:
                    chars |= {_lower(chr(c)) for c in range(item[0], item[1] + 1)}
                else:
                    chars |= set(map(str, range(MOST_LITERALS + 1)))
            options = chars if len(chars) <= 8 else None
        elif op is tokens.SUBPATTERN:
            inner, options = _literals(value[3])
            needed += inner if options is None else []
        elif op is tokens.BRANCH:
            parts = [_literals(branch) for branch in value[1]]
            if all(p[1] is not None for p in parts):
                options = set().union(*(p[1] for p in parts))
            elif all(p[0] or (p[1] and all(len(s) >= 3 for s in p[1])) for p in parts):
                needed.append(set().union(*(p[1] if p[1] is not None else p[0][0] for p in parts)))
        elif op in (tokens.MAX_REPEAT, tokens.MIN_REPEAT):
            low, high, body = value
            inner, once = _literals(body)
            if once is not None and low == 0 and high == 1:
                options = once | {""}
            elif once is not None and low == high and len(once) ** low <= MOST_LITERALS:
                options = {""}
                for _ in range(low):
                    options = {a + b for a in options for b in once}
            elif low > 0 and once is None:
                needed += inner
            elif low > 0 and once and all(len(s) >= 3 for s in once):
                needed.append(set(once))
        elif op is tokens.AT:
            options = {""}
        if options is None or len(current) * len(options) > MOST_LITERALS:
            close()
            exact = False
            current = {""} if options is None else set(options)
        else:
            current = {a + b for a in current for b in options}
    if exact:
        return needed, current
    close()
    return needed, None


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """The Boolean query of a pattern: a conjunction of disjunctions of trigram sets.

    A match's lower-cased text has, for every outer item, all trigrams of one of its inner
    sets. An empty list means that no trigram is mandatory and the rule scans everything.
    """
    needed, whole = _literals(parser.parse(pattern))
    if whole is not None and all(len(s) >= 3 for s in whole):
        needed = [*needed, whole]
    query = []
    for alternatives in needed:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in alternatives}
        # A set that holds another one asks for more than the disjunction needs.
        query.append(sorted((s for s in sets if not any(t < s for t in sets)), key=sorted))
    return query


def _trie(trigrams) -> str:
    """A pattern for any of the trigrams that shares their first characters."""
    first: dict = {}
    for t in sorted(trigrams):
        first.setdefault(t[0], []).append(t[1:])
    return "|".join(f"{re.escape(a)}(?:{'|'.join(map(re.escape, rest))})" for a, rest in first.items())


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def postings(df: DataFrame, key: Column, text: Column, trigrams) -> DataFrame:
    """The inverted index: one row (trigram, doc) for each of ``trigrams`` that a text has."""
    found = F.regexp_extract_all(_ascii_lower(text), F.lit(f"(?s)(?=({_trie(trigrams)}))"), F.lit(1))
    return df.select(F.explode(F.array_distinct(found)).alias("trigram"), key.alias("doc"))


def candidates(df: DataFrame, key: Column, text: Column, rules) -> DataFrame | None:
    """doc, kinds: which indexed rules can match in which documents.

    Postings meet each other by document, never by trigram, so a frequent trigram fills no
    task. Every posting becomes one bit per document, merged before the shuffle.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    queries = {kind: query for kind, query in queries.items() if query}
    if not queries:
        return None
    trigrams = sorted({t for query in queries.values() for sets in query for s in sets for t in s})
    place = F.array_position(F.array(*map(F.lit, trigrams)), F.col("trigram")) - 1
    words = range(-(-len(trigrams) // BITS))
    bit = F.expr(f"shiftleft(1L, CAST(place % {BITS} AS INT))")
    held = (
        postings(df, key, text, trigrams)
        .withColumn("place", place)
        .groupBy("doc")
        .agg(*(F.bit_or(F.when(F.floor(F.col("place") / BITS) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"m{w}") for w in words))
    )

    def has(trigrams_of_set):
        masks = [0] * len(words)
        for t in trigrams_of_set:
            w, b = divmod(trigrams.index(t), BITS)
            masks[w] |= 1 << b
        return reduce(Column.__and__, (F.col(f"m{w}").bitwiseAND(F.lit(m)) == m for w, m in enumerate(masks) if m))

    met = {
        kind: reduce(Column.__and__, (reduce(Column.__or__, map(has, sets)) for sets in query))
        for kind, query in queries.items()
    }
    kinds = F.array_compact(F.array(*(F.when(met[k], F.lit(k)) for k in met)))
    return held.select("doc", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def _spans(text: Column, order: int, rule: Rule) -> Column:
    """The rule's spans in a text: (start, order, end) in code points, end exclusive."""
    # A lazy run up to the next match gives the gap before each match, leftmost first. It
    # starts where the match before it ended (\\G), so the rest of a text is read once.
    pattern = rf"(?s)\G(.*?)({rule.pattern})"
    # One group before it, and one around the match.
    gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    held = F.regexp_extract_all(text, F.lit(pattern), F.lit(2 + rule.group)) if rule.group else found
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("found"), held.alias("held"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rule:int,end:int>>").alias("spans"))

    def step(state, part):
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.length(part["found"])
        span = F.struct(begin.alias("start"), F.lit(order).alias("rule"), end.alias("end"))
        spans = F.when(F.length(part["held"]) >= rule.least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(parts, start, step, lambda state: state["spans"])


def secret_spans(df: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """``df`` with ``__spans``: all secrets, an array of (start, rule, end) sorted.

    ``rule`` is the place of the rule in ``rules``. Null text is empty. Rows keep their number
    and columns. Rows that share a key, null keys included, are verified
    if any of them is a candidate, each in its own text, so repeated keys cost time only.
    """
    found = candidates(df, F.col(key), F.coalesce(F.col(text), F.lit("")), rules)
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    if found is None:
        joined = df.withColumn("__kinds", F.array().cast("array<string>"))
    else:
        found = small_side(found, "candidates").select(F.col("doc").alias("__doc"), F.col("kinds").alias("__kinds"))
        joined = df.join(found, F.col(key).eqNullSafe(F.col("__doc")), "left").drop("__doc")
    whole = F.coalesce(F.col(text), F.lit(""))
    parts = []
    for order, rule in enumerate(rules):
        spans = _spans(whole, order, rule)
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains("__kinds", rule.kind), spans).otherwise(none)
        parts.append(spans)
    return joined.withColumn("__spans", F.array_sort(F.concat(*parts))).drop("__kinds")


def span_text(spans: Column, rules=RULES) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    shown = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"], s["end"]))
    return F.array_join(shown, ",")


def span_count(spans: Column, order: int) -> Column:
    """How many spans are of the rule at place ``order`` of the rules."""
    return F.size(F.filter(spans, lambda s: s["rule"] == order)).cast("long")


def redact(df: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES, mask: str = "[secret]") -> DataFrame:
    """``df`` with every secret in ``text`` replaced by ``mask``; overlapping spans make one.

    Texts without secrets, null ones included, stay as they are.
    """
    found = secret_spans(df, key, text, rules)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state, span):
        fresh = span["start"] >= state["at"]
        gap = F.substring(F.col(text), state["at"] + 1, span["start"] - state["at"])
        first = (F.size(state["parts"]) == 0) | (span["start"] > state["at"])
        parts = F.when(fresh & first, F.concat(state["parts"], F.array(gap, F.lit(mask)))).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), parts.alias("parts"))

    def finish(state):
        rest = F.substring(F.col(text), state["at"] + 1, F.length(text))
        return F.array_join(F.concat(state["parts"], F.array(rest)), "")

    clean = F.when(F.size("__spans") == 0, F.col(text)).otherwise(F.aggregate("__spans", start, step, finish))
    return found.withColumn(text, clean).drop("__spans")
