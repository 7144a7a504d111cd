"""The whole pipeline against a plain version of each stage."""

import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from clickflow.llm import line_dedup, packing, quality, secret_scan

WORDS = re.compile("[^\x20\x09-\x0d]+")
COMMON = ["the", "of", "and", "to", "in"]


def char_class(c):
    if c.isspace():
        return 4
    if c in "#*$%&|<>":
        return 5
    kind = unicodedata.category(c)
    return {"Ll": 0, "Lu": 1, "Lt": 1}.get(kind, 2 if kind[0] == "L" else 3 if kind[0] == "N" else 6)


def distance(p, q):
    total = 0.0
    for key in p.keys() | q.keys():
        a, b = p.get(key, 0), q.get(key, 0)
        for x in (a, b):
            if x:
                total += x * math.log2(2 * x / (a + b)) / 2
    return math.sqrt(max(0.0, total))


def shares(counter):
    total = sum(counter.values())
    return {k: n / total for k, n in counter.items()}


def plain_quality(docs):
    words, chars = defaultdict(Counter), defaultdict(Counter)
    for d in docs:
        words[d["lang"] or ""].update(WORDS.findall(d["text"] or ""))
        chars[d["lang"] or ""].update(map(char_class, d["text"] or ""))
    kept = []
    for d in docs:
        text, lang = d["text"] or "", d["lang"] or ""
        own = WORDS.findall(text)
        n = len(own)
        windows = Counter(zip(own, own[1:], own[2:]))
        repeated = {i + k for i, w in enumerate(zip(own, own[1:], own[2:])) if windows[w] > 1 for k in range(3)}
        if n < 50 or 100 * len(repeated) > 50 * n:
            continue
        total = sum(words[lang].values())
        common = {w for w, k in words[lang].items() if k >= quality.COMMON_SHARE * total}

        def spread(counter, common=common):
            out = Counter()
            for w, k in counter.items():
                out[w if w in common else None] += k
            return shares(out)

        far = distance(shares(Counter(map(char_class, text))), shares(chars[lang])) > quality.MAX_CHAR_DISTANCE
        limit = math.sqrt(quality.WORD_DISTANCE**2 + len(common) / (8 * math.log(2) * n))
        if not far and distance(spread(Counter(own)), spread(words[lang])) <= limit:
            kept.append(d)
    return kept


def plain_lines(docs):
    pages, counts = Counter(d["source"] for d in docs), Counter()
    for d in docs:
        counts.update({(d["source"], line) for line in d["text"].split("\n") if WORDS.search(line)})
    gone = {k for k, n in counts.items() if n >= line_dedup.MIN_PAGES and n > line_dedup.MAX_RATIO * pages[k[0]]}
    return [{**d, "text": "\n".join(x for x in d["text"].split("\n") if (d["source"], x) not in gone)} for d in docs]


def plain_near(docs):
    def shingles(text):
        words = text.encode().lower().split()
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets, label = [shingles(d["text"]) for d in docs], list(range(len(docs)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 4 * both >= 3 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    first = {}
    for i, d in enumerate(docs):
        first[find(i)] = min(first.get(find(i), d["doc_id"]), d["doc_id"])
    return [d for i, d in enumerate(docs) if first[find(i)] == d["doc_id"]]


def plain_mask(docs):
    out = []
    for d in docs:
        spans = sorted(
            m.span() for r in secret_scan.RULES for m in re.finditer(r.pattern, d["text"], re.ASCII) if len(m[r.group]) >= r.least
        )
        parts, at = [], 0
        for start, end in spans:
            if start > at or not parts:
                parts += [d["text"][at:start], "[secret]"]
            at = max(at, end)
        out.append({**d, "text": "".join(parts) + d["text"][at:]})
    return out


def corpus():
    rng = np.random.default_rng(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rare = ["".join(rng.choice(list(letters), 7)) for _ in range(800)]

    def prose(n=150):
        words = [str(rng.choice(COMMON)) if rng.random() < 0.4 else str(rng.choice(rare)) for _ in range(n)]
        return "\n".join(" ".join(words[i : i + 12]) for i in range(0, n, 12))

    docs = []
    for i in range(90):
        text = prose()
        if i % 3 == 0:
            text = "terms of use apply here\n" + text
        if i % 10 == 0:
            text += "\ntoken = \"6df57b16f87eabefefcab67b433efd90636bb6bd\" the end"
        docs.append((i, text))
    words = docs[4][1].split(" ")
    docs += [(200 + k, " ".join(words[:k] + ["changed"] + words[k + 1 :])) for k in (10, 50)]
    docs += [(300, docs[5][1]), (301, "#$% & " * 200), (302, "short"), (303, None), (304, "same words here " * 80)]
    return docs


def test_the_pipeline_matches_its_plain_version(spark, documents, tmp_path):
    documents(*corpus()).write.parquet(str(tmp_path / "documents.parquet"))
    docs = [r.asDict() for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()]
    plain = (plain_quality, plain_lines, plain_near, plain_mask)
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = table.columns
    for k, ((name, stage), expected) in enumerate(zip(corpus_pipeline.STAGES, plain)):
        table = stage(spark, table, str(tmp_path))
        assert table.columns == columns, name
        table.write.parquet(str(tmp_path / f"stage{k}"))
        table = spark.read.parquet(str(tmp_path / f"stage{k}"))
        before = len(docs)
        changed = expected(docs)
        assert changed != docs, f"{name} has nothing to do here"
        docs = [{**d, "n_chars": len(d["text"])} for d in changed]
        assert sorted((r.doc_id, r.text, r.n_chars) for r in table.collect()) == sorted((d["doc_id"], d["text"], d["n_chars"]) for d in docs), (name, before)
    encode = packing.encoder()
    pieces = set()
    for d in docs:
        ids = np.array([*encode(d["text"]), 0], dtype="<u4")
        pieces |= {(d["doc_id"], s, len(ids[s : s + 1024]), zlib.crc32(ids[s : s + 1024].tobytes())) for s in range(0, len(ids), 1024)}
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.start, r.length, r.ids_crc32) for r in found} == pieces and len(found) == len(pieces)


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "secret_scan", "packing"]


def test_an_empty_table_passes(spark, documents, tmp_path):
    documents().write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
