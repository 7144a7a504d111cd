"""Periodic runs against a plain search of every start and period."""

import hashlib
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickflow.llm import periodic_runs, queries
from clickflow.llm.common import read_table


def plain(words, least=24, periods=3):
    """(start, length, period) of all runs, period by period."""
    found, n = [], len(words)
    names = {word: i for i, word in enumerate(dict.fromkeys(words))}
    ids = np.array([names[word] for word in words])
    for period in range(1, n // periods + 1):
        same = ids[:-period] == ids[period:]
        if not same.any():
            continue
        edges = np.diff(np.concatenate([[0], same, [0]]))
        for start, end in zip(np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)):
            length = int(end - start) + period
            part = ids[start : start + length]
            if length >= max(least, periods * period) and not any((part[d:] == part[:-d]).all() for d in range(1, period)):
                found.append((int(start), length, period))
    return sorted(found)


word_lists = st.lists(st.integers(0, 2), max_size=40)


@settings(max_examples=300, deadline=None)
@given(word_lists, st.integers(1, 9), word_lists, st.integers(0, 50))
def test_runs_match_a_plain_search(before, period, unit, length):
    unit = (unit or [1])[:period]
    words = before + [unit[i % len(unit)] for i in range(length)] + before[::-1]
    for least, periods in ((24, 3), (2, 2), (6, 3), (10, 4)):
        wanted = plain(words, least, periods)
        assert periodic_runs.text_runs(words, least, periods) == wanted
        assert periodic_runs.runs_of(words, least, periods) == wanted


def test_smallest_period_and_limits():
    assert periodic_runs.text_runs(list("ab" * 12)) == [(0, 24, 2)]
    assert periodic_runs.text_runs(list("ab" * 11 + "a")) == []
    assert periodic_runs.text_runs(list("abcdefghi" * 3)) == [(0, 27, 9)]
    assert periodic_runs.text_runs(list("abcdefghi" * 2 + "abcdefgh")) == []
    assert periodic_runs.text_runs(["x"] * 30) == [(0, 30, 1)]


def test_runs_inside_runs():
    unit = ["x"] * 24 + ["y"]
    words = unit * 3 + ["x"] * 3
    assert periodic_runs.text_runs(words) == plain(words)
    assert len(plain(words)) == 4


def test_collapsing_drops_repeats_of_any_run():
    words = list("ab" * 13 + "c")
    assert periodic_runs.collapsed(words, [(0, 26, 2)]) == ["a", "b", "c"]
    assert periodic_runs.collapsed(words, []) == words
    assert periodic_runs.collapsed(words, [(0, 26, 2), (20, 7, 1)]) == ["a", "b"]


@pytest.mark.parametrize("unit", [1, 2, 7, 1_000])
def test_long_repetitive_texts(unit):
    words = [b"%d" % (i % unit) for i in range(200_000)]
    began = time.process_time()
    assert periodic_runs.text_runs(words) == [(0, 200_000, unit)]
    assert time.process_time() - began < 20


def test_long_texts_of_nested_repeats():
    a, b = [0], [0, 1]
    while len(b) < 20_000:
        a, b = b, b + a
    runs = periodic_runs.text_runs(b)
    assert runs and all(length >= max(24, 3 * period) for _, length, period in runs)
    assert runs[:50] == plain(b[:6_000])[:50]


def rows_of(df):
    return sorted((str(r.doc_id), [tuple(run) for run in r.runs], r.collapsed) for r in df.collect())


def test_nulls_repeated_rows_and_clashing_names(documents):
    text = "é " + "a\tb \n" * 15 + "c"
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, " \n ")]
    df = documents(*rows).withColumnsRenamed({"component": "runs", "host": "collapsed", "label": "start"})
    run = [(1, 30, 2)]
    wanted = [("1", run, "é a b c")] * 2 + [("2", [], ""), ("3", [], ""), ("4", [], ""), ("None", run, "é a b c")]
    assert rows_of(periodic_runs.periodic_runs(df)) == wanted
    assert rows_of(periodic_runs.periodic_runs(documents())) == []


def test_other_limits(documents):
    df = documents((1, "a b a b a"))
    assert rows_of(periodic_runs.periodic_runs(df, least=4, periods=2)) == [("1", [(0, 5, 2)], "a b")]


def contract_row(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    shown = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    figures = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc, len(runs), *figures, *(hashlib.sha256(t.encode()).hexdigest() for t in (shown, kept)))


def test_registered_query_on_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    found = queries.op11_periodic_runs(spark, sf_dir)
    wanted = [contract_row(*row) for row in rows]
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert sum(row[1] > 0 for row in wanted) >= 5
    assert all(kind in ("bigint", "string") for _, kind in found.dtypes)


def test_registered_query_on_ties_and_nulls(spark, tmp_path):
    # Ids whose checksum is a multiple of ten, and others.
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:8] + [1, 2, 3]
    texts = ["a b c " * 20, "x", "", None, " ".join(map(str, range(90))), "p " * 24 + "q " * 24, "a b " * 40 + "c d e " * 40]
    rows = [(i, t) for i in ids for t in texts]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr(contract_row(*row)) for row in rows)
