"""Quality rules by distribution divergence.

A document's histograms of character classes and of its language's common words are
compared with the language's own, summed over all documents, by Jensen-Shannon distance.
"""

import base64
import json
import math
import unicodedata
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import SPACES, small_side, staged, tidy

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A word is common in a language from this share of the language's words on: at most 1,000 are.
COMMON_SHARE = 0.001
# The words of a language of fewer, in a table of any size, say too little about shares of single
# words. What counts there is how many of a text's words its other texts have too.
LANGUAGE_WORDS = 5_000
# References of languages with this share of all words are kept on the driver: at most 1,000
# are. Those of the others are a written table, joined to their texts.
LANGUAGE_SHARE = 0.001
LANGUAGES_CACHED = 1_000
MAX_CHAR_DISTANCE = 0.3
# How far a text's words may be from its language's, beyond what drawing few words does by itself.
WORD_DISTANCE = 0.25

CLASSES = ("lower", "upper", "letter", "digit", "space", "symbol", "other")
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, char_distance double, word_distance double, kept boolean"

_table = None


def _class_of(char: str) -> int:
    if char.isspace():
        return 4
    if char in "#*$%&|<>":
        return 5
    kind = unicodedata.category(char)
    return {"Ll": 0, "Lu": 1, "Lt": 1}.get(kind, 2 if kind[0] == "L" else 3 if kind[0] == "N" else 6)


def char_classes(text: bytes) -> np.ndarray:
    """Number of code points by class; what lies above U+FFFF counts as other."""
    global _table
    if _table is None:
        _table = np.array([_class_of(chr(c)) for c in range(0x10000)] + [6], dtype=np.uint8)
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), dtype="<u4")
    return np.bincount(_table[np.minimum(points, 0x10000)], minlength=len(CLASSES))


def repeat_words(words: list) -> int:
    """Words inside 3-word windows that the text has twice or more, the first ones included."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    if len(seen) == n:
        return 0
    # Pairs, then windows, are numbered densely, so that no product overflows.
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    _, window, counts = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[window] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def base_measures(text: bytes, words: list) -> tuple:
    seen, dup_lines = set(), 0
    for line in text.split(b"\n"):
        if line.strip(SPACES):
            if line in seen:
                dup_lines += 1
            seen.add(line)
    spaces = len(text) - len(text.translate(None, SPACES))
    n, repeats = len(words), repeat_words(words)
    return (
        n,
        len(text.decode("utf-8", "replace")) - spaces,
        len(text) - len(text.translate(None, SYMBOLS)),
        dup_lines,
        repeats,
        n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n,
    )


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two distributions, from 0 to 1."""
    middle = (p + q) / 2

    def divergence(a):
        held = a > 0
        return float((a[held] * np.log2(a[held] / middle[held])).sum())

    return math.sqrt(max(0.0, (divergence(p) + divergence(q)) / 2))


def word_limit(n: int, bins: int) -> float:
    """The largest accepted word distance of a text of ``n`` words: short texts scatter more.

    The squared distance of a sample of the language itself is about bins / (8 ln 2 n).
    """
    return math.sqrt(WORD_DISTANCE**2 + bins / (8 * math.log(2) * n))


def coverage_limit(n: int, reference: float = math.inf) -> float:
    """The largest accepted coverage distance of a text of ``n`` words from a reference of so many.

    Common words and all others are two bins, so chance adds little even to 50 words; three
    standard deviations of it, on both sides, are allowed for.
    """
    return math.sqrt(WORD_DISTANCE**2 + 9 / (8 * math.log(2)) * (1 / n + 1 / reference))


def coverage_distance(share: float, wanted: float) -> float:
    """How far a text's share of known words is below the wanted one; none if it is not below."""
    if share >= wanted:
        return 0.0
    return distance(np.array([share, 1 - share]), np.array([wanted, 1 - wanted]))


def _scripts_merged(classes: np.ndarray) -> np.ndarray:
    """Letters of every script and case as one class."""
    return np.array([classes[:3].sum(), *classes[3:]])


def _rows(batch, text_col, lang_col):
    texts = batch.column(text_col).cast(pa.binary()).to_pylist()
    langs = batch.column(lang_col).to_pylist()
    return ((text or b"", lang or "") for text, lang in zip(texts, langs))


def _by_language(batch, text_col, lang_col):
    words: dict = defaultdict(Counter)
    chars: dict = defaultdict(lambda: np.zeros(len(CLASSES), dtype=np.int64))
    texts: Counter = Counter()
    for text, lang in _rows(batch, text_col, lang_col):
        words[lang].update(text.split())
        chars[lang] += char_classes(text)
        texts[lang] += 1
    return words, chars, texts


def _counts(rows):
    return pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([r[0] for r in rows], pa.string()),
            "kind": pa.array([r[1] for r in rows], pa.string()),
            "key": pa.array([r[2] for r in rows], pa.binary()),
            "n": pa.array([int(r[3]) for r in rows], pa.int64()),
        }
    )


_COUNTS = "lang string, kind string, key binary, n long"


def _together(counters: dict) -> Counter:
    every: Counter = Counter()
    for counter in counters.values():
        every.update(counter)
    return every


def _references(df: DataFrame, text: str, lang: str) -> tuple[dict, DataFrame | None]:
    """References kept on the driver, by language and under None over all languages, and a
    table (lang, reference) of the others, if there are any; see ``references``."""
    docs = df.select(text, lang)

    def candidates(batches):
        for batch in batches:
            words, chars, texts = _by_language(batch, text, lang)
            words[None] = _together(words)
            chars[None] = sum(chars.values(), np.zeros(len(CLASSES), dtype=np.int64))
            rows = []
            for name, counter in words.items():
                total = counter.total()
                rows += [(name, "words", b"", total), (name, "texts", b"", texts[name])]
                rows += [(name, "class", str(i).encode(), n) for i, n in enumerate(chars[name])]
                rows += [(name, "word", w, n) for w, n in counter.items() if n >= COMMON_SHARE / 2 * total]
            yield _counts(rows)

    counted = docs.mapInArrow(tidy(candidates), _COUNTS).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    counted, _ = staged(counted, "language_counts")
    totals = counted.filter(f"kind = 'words' AND n > 0 AND (lang IS NULL OR n >= {LANGUAGE_WORDS})").select("lang", F.col("n").alias("total"))
    everything = totals.filter("lang IS NULL").agg(F.sum("total")).first()[0] or 0
    sizes = {row.lang: row.total for row in totals.filter(F.col("total") >= LANGUAGE_SHARE * everything).collect()}
    large = F.broadcast(totals.filter(F.col("total") >= LANGUAGE_SHARE * everything).withColumnRenamed("lang", "name"))
    others = totals.filter(F.col("total") < LANGUAGE_SHARE * everything)
    near = counted.join(large, F.col("lang").eqNullSafe(F.col("name")))
    near = near.filter(f"kind = 'class' OR kind = 'word' AND n >= {COMMON_SHARE / 2} * total")
    wanted: dict = {name: set() for name in sizes}
    classes = {name: np.zeros(len(CLASSES)) for name in sizes}
    for row in near.collect():
        if row.kind == "class":
            classes[row.lang][int(bytes(row.key))] = row.n
        else:
            wanted[row.lang].add(bytes(row.key))

    def exact(batches):
        for batch in batches:
            counters: dict = defaultdict(Counter)
            having: dict = defaultdict(Counter)
            for t, name in _rows(batch, text, lang):
                own = t.split()
                counters[name].update(own)
                if name not in wanted:
                    having[name].update(set(own))
            counters[None] = _together(counters)
            # Words of languages that are not kept on the driver are all counted, and texts that have them.
            rows = [(name, "word", w, c[w]) for name, c in counters.items() for w in wanted.get(name, c) if c[w]]
            rows += [(name, "having", w, n) for name, c in having.items() for w, n in c.items()]
            yield _counts(rows)

    every = docs.mapInArrow(tidy(exact), _COUNTS).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    every, _ = staged(every, "word_counts")
    found = every.filter("kind = 'word'")
    common = F.col("n") >= COMMON_SHARE * F.col("total")
    shares: dict = defaultdict(dict)
    for row in found.join(large, F.col("lang").eqNullSafe(F.col("name"))).filter(common).collect():
        shares[row.lang][bytes(row.key)] = row.n / sizes[row.lang]
    held = {
        name: (dict(sorted(shares[name].items())), tuple(classes[name] / max(1, classes[name].sum())))
        for name in sizes
    }
    small = counted.filter(f"kind = 'words' AND n > 0 AND n < {LANGUAGE_WORDS}").select("lang", F.col("n").alias("total"))
    if others.isEmpty() and small.isEmpty():
        return held, None
    pairs = F.collect_list(F.struct("key", "n"))
    words = found.join(others, "lang").filter(common).groupBy("lang").agg(pairs.alias("words"))
    spread = counted.filter("kind = 'class'").join(others, "lang").groupBy("lang").agg(pairs.alias("classes"))
    more = others.join(spread, "lang").join(words, "lang", "left")
    more = more.select("lang", F.to_json(F.struct("total", "words", "classes")).alias("reference"))
    texts = counted.filter("kind = 'texts'").select("lang", F.col("n").alias("texts"))
    shared = every.filter("kind = 'having' AND n > 1").join(small, "lang").groupBy("lang").agg(F.collect_list("key").alias("shared"))
    few = small.join(texts, "lang").join(shared, "lang", "left")
    few = few.select("lang", F.to_json(F.struct("total", "texts", "shared")).alias("reference"))
    return held, small_side(more.unionByName(few), "language_references")


def references(df: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Per language: its common words with their shares, and its shares of character classes.

    Counted over all rows in two passes. A word with the common share of all words has at
    least that share in some batch, and batches that leave a word out because it has less than half
    of it there lose less than half of it: so the first pass finds every common word among
    at most 2 / ``COMMON_SHARE`` candidates per language, and the second counts these exactly.
    None stands for all languages together. Languages below ``LANGUAGE_SHARE`` are left out here.
    """
    return _references(df, text, lang)[0]


@dataclass(frozen=True)
class Small:
    """What is known of a small language: its number of words and texts, and the words that several texts have."""

    total: int
    texts: int
    shared: frozenset


def _reference_of(data: str) -> "tuple | Small":
    """A reference out of the table of them."""
    row = json.loads(data)
    if "texts" in row:
        return Small(row["total"], row["texts"], frozenset(map(base64.b64decode, row.get("shared", ()))))
    shares = {base64.b64decode(w["key"]): w["n"] / row["total"] for w in row.get("words", ())}
    classes = np.zeros(len(CLASSES))
    for c in row["classes"]:
        classes[int(base64.b64decode(c["key"]))] = c["n"]
    return dict(sorted(shares.items())), tuple(classes / max(1, classes.sum()))


def _with_references(df: DataFrame, more: DataFrame | None, lang: str) -> DataFrame:
    """``df`` with ``__reference``, null where the driver keeps the language's or there is none."""
    if more is None:
        return df.withColumn("__reference", F.lit(None).cast("string"))
    side = more.select(F.col("lang").alias("__name"), F.col("reference").alias("__reference"))
    return df.join(side, F.coalesce(F.col(lang), F.lit("")) == F.col("__name"), "left").drop("__name")


def _judged(batch, text: str, lang: str, held: dict, cached: dict) -> list:
    rows = []
    more = batch.column("__reference")
    for i, (data, name) in enumerate(_rows(batch, text, lang)):
        reference = held
        if more[i].is_valid:
            if name not in cached:
                if len(cached) >= LANGUAGES_CACHED:
                    cached.clear()
                cached[name] = _reference_of(more[i].as_py())
            reference = cached
        rows.append(judge(data, name, reference, held.get(None)))
    return rows


def judge(text: bytes, lang: str, reference: dict, together: tuple | None = None) -> tuple:
    """The values of ``MEASURES`` for one text; ``together`` is the reference of all languages."""
    words = text.split()
    base = base_measures(text, words)
    n, failed = base[0], base[-1]
    if failed or not reference:
        return (*base, None, None, not failed)
    own_reference = reference.get(lang)
    if own_reference is None or isinstance(own_reference, Small):
        return (*base, *_judge_small(text, words, own_reference, together or reference[None]))
    shares, classes = own_reference
    seen = char_classes(text)
    char_distance = distance(seen / seen.sum(), np.array(classes))
    counter = Counter(words)
    own = np.array([counter[w] for w in shares] + [0.0])
    own[-1] = n - own.sum()
    ref = np.array([*shares.values(), 0.0])
    ref[-1] = max(0.0, 1 - ref.sum())
    # A short text scatters over many bins, but hardly in how many of its words are common ones.
    coverage = coverage_distance(1 - own[-1] / n, 1 - ref[-1])
    near = char_distance <= MAX_CHAR_DISTANCE and coverage <= coverage_limit(n)
    word_distance = distance(own / n, ref)
    near = near and word_distance <= word_limit(n, len(shares))
    return (*base, char_distance, word_distance, near)


def _judge_small(text: bytes, words: list, small: Small | None, together: tuple) -> tuple:
    """char_distance, word_distance and kept of a text in a small language.

    Its letters, digits and symbols are held against those of all languages, whatever its script. In
    a language, texts have words in common: as large a share of words as common ones make up in
    all languages, less what chance explains, should also be in other texts of its own, or
    be common ones of all languages, as under a mistyped name. The only text of its language has no
    others, and its words are not judged.
    """
    shares, classes = together
    n, seen = len(words), char_classes(text)
    char_distance = distance(_scripts_merged(seen) / seen.sum(), _scripts_merged(np.array(classes)))
    wanted = sum(shares.values())
    known = coverage_distance(sum(w in shares for w in words) / n, wanted)
    near, word_distance = known <= coverage_limit(n), known
    if small is not None and not near:
        own = coverage_distance(sum(w in small.shared for w in words) / n, wanted)
        word_distance = min(known, own)
        near = small.texts < 2 or own <= coverage_limit(n, max(1, small.total - n))
    return char_distance, word_distance, char_distance <= MAX_CHAR_DISTANCE and near


def quality_measures(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: ``key`` and ``MEASURES``.

    Null text counts as empty, which fails the base rule; a null language is the language
    ''. Documents that fail the base rule have null
    distances. In languages of fewer than ``LANGUAGE_WORDS`` words ``word_distance`` is that of the
    share of words that other texts have too, see ``_judge_small``. Repeated rows are each judged. Words are runs of anything but
    ASCII white space; bytes that are not UTF-8 count as one replacement character each run.
    """
    held, more = _references(df, text, lang)
    cached: dict = {}
    schema = df.select(key).schema

    def measure(batches):
        for batch in batches:
            rows = _judged(batch, text, lang, held, cached)
            columns = list(zip(*rows)) if rows else [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            names = [key, *(part.split()[0] for part in MEASURES.split(", "))]
            arrays = [batch.column(key), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    for part in MEASURES.split(", "):
        schema = schema.add(*part.split())
    return _with_references(df.select(key, text, lang), more, lang).mapInArrow(tidy(measure), schema)


def quality_filter(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``df``, all columns, that ``quality_measures`` keeps."""
    held, more = _references(df, text, lang)
    cached: dict = {}

    names = df.columns

    def passing(batches):
        for batch in batches:
            kept = pa.array([row[-1] for row in _judged(batch, text, lang, held, cached)], pa.bool_())
            yield batch.select(names).filter(kept)

    return _with_references(df, more, lang).mapInArrow(tidy(passing), df.schema)
