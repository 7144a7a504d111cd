import hashlib
import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickflow.llm import suffix_dedup
from clickflow.llm.suffix_dedup import LENGTH


def plain(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), []
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - LENGTH + 1):
            window = data[at : at + LENGTH]
            if window in seen:
                gone[at : at + LENGTH] = b"\1" * LENGTH
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for at, g in enumerate(gone) if g and not (at and gone[at - 1]))
        out.append((rows[i][0], len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(documents, rows):
    return sorted((tuple(r)[:5] for r in suffix_dedup.suffix_dedup(documents(*rows)).collect()), key=str)


@given(st.binary(min_size=1, max_size=60) | st.lists(st.sampled_from([1, 2]), min_size=1, max_size=80).map(bytes))
def test_suffix_array_is_sorted(data):
    text = np.frombuffer(data, dtype=np.uint8)
    order = suffix_dedup.suffix_array(text).tolist()
    assert sorted(order) == list(range(len(data)))
    padded = [data[i:] + bytes(len(data)) for i in order]
    assert padded == sorted(padded)


def test_windows_shared_across_pieces_only_count_inside_them():
    same = bytes(range(120))
    text = np.frombuffer(same + same + b"x" * 30, dtype=np.uint8)
    begins = np.array([0, 120, 240, 270])
    keys = np.arange(270)
    assert suffix_dedup.shared_windows(text, begins, keys).tolist() == list(range(120, 141))


def random_text(rng, n):
    return "".join(rng.choice("abcdefghij klmno\né") for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2])
def test_removal_matches_brute_force(documents, seed):
    rng = random.Random(seed)
    shared = [random_text(rng, rng.randrange(60, 400)) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [rng.choice(shared)[rng.randrange(30) :] if rng.random() < 0.5 else random_text(rng, rng.randrange(200)) for _ in range(rng.randrange(5))]
        rows.append((i, "".join(parts)))
    rng.shuffle(rows)
    assert found(documents, rows) == plain(rows)


def test_grams_with_many_surroundings_are_split(documents, monkeypatch):
    rng = random.Random(8)
    passage = random_text(rng, 180)
    rows = [(i, random_text(rng, 150) + passage + random_text(rng, 150)) for i in range(40)]
    rows += [(50, rows[3][1][100:420]), (51, rows[3][1][100:419] + "z")]
    monkeypatch.setattr(suffix_dedup, "HOT_GRAM", 8)
    hot = []
    search = suffix_dedup.hot_grams
    monkeypatch.setattr(suffix_dedup, "hot_grams", lambda *a: hot.append(search(*a)) or hot[0])
    assert found(documents, rows) == plain(rows)
    assert len(hot[0])


def test_overlaps_runs_and_lengths_at_the_limit(documents):
    rng = random.Random(4)
    a = random_text(rng, 300).replace("é", "e")
    rows = [
        (1, "x" * 350), (2, "x" * 99), (3, "x" * 100), (4, "ab" * 150), (5, a), (6, "q" + a[50:149]), (7, "q" + a[50:150] + "q"),
        (8, a[:200] + a[100:300]), (9, a), (10, None), (11, ""), (12, "é" * 120), (13, "é" * 40), (14, "\0" * 130), (15, "\0" * 101 + "x"),
    ]
    assert found(documents, rows) == plain(rows)


def test_null_and_repeated_ids(documents):
    rng = random.Random(5)
    a, b = random_text(rng, 150), random_text(rng, 250)
    rows = [(1, a), (1, a), (1, b), (None, a), (None, b + a), (2, b), (2, "short")]
    assert found(documents, rows) == plain(rows)


def test_long_texts_cross_blocks(documents, monkeypatch):
    rng = random.Random(6)
    words = [random_text(rng, 9) for _ in range(3000)]
    text = "".join(rng.choice(words) for _ in range(150_000))
    copied = "start " + text[1_047_000:1_050_000] + " end"
    rows = [(1, text), (2, copied), (3, text[:5000])]
    got = {r[0]: r[1:] for r in found(documents, rows)}
    assert got == {r[0]: r[1:] for r in plain(rows)}


def test_empty_table(documents):
    assert found(documents, []) == []


def test_rows_of_one_id_are_numbered_over_many_tasks(spark, documents, monkeypatch):
    texts = [f"text {i % 37:02d}" for i in range(300)] + ["same"] * 200
    rows = [(None if i % 3 else 5, t) for i, t in enumerate(texts)] + [(9, "alone"), (10, None)]
    monkeypatch.setattr(suffix_dedup, "RANKED_BYTES", 400)
    found = [(r.doc, r.copy, r.text) for r in suffix_dedup.numbered(documents(*rows), "doc_id", "text").select("doc", F.col("copy").alias("copy"), "text").collect()]
    by = {}
    for doc, copy, text in sorted(found):
        by.setdefault(doc, []).append((copy, text))
    assert by.pop(9) == [(0, "alone")] and by.pop(10) == [(0, "")]
    for doc, own in ((-(2**63), [t for i, t in enumerate(texts) if i % 3]), (5, texts[::3])):
        assert by.pop(doc) == list(enumerate(sorted(own), 1))
    assert not by
