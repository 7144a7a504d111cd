"""Periodic runs of words: a suffix automaton whose link tree is coloured by link-cut accesses.

Every state of the automaton remembers where its strings ended last. When word i has been read,
the path from the state of the whole prefix up to the root takes the colour i; before, it fell
into segments that ended last at the same earlier place j. The longest string of such a segment
then ends at both j and i, and where it is as long as i - j, the two make a square of that
period. Its start cannot be moved left, and the last i that names the same start and period ends the run.

Accesses change amortized few segments. The automaton is finished before the first access, so that
its tree keeps still: heavy paths hold their segments as stacks, and an access pops what it recolours.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.common import tidy

LEAST_LENGTH = 24
LEAST_PERIODS = 3
# How often stretches without inner repeats are cut off before the automaton is built.
CUTS = 4
_ODD = np.int64(0x5851F42D4C957F2D)


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length and suffix link of every state, and the state of every prefix; state 0 is the root.

    A state's first transition is kept in two lists, further ones in a dictionary.
    """
    length, link, word, to, more = [0], [-1], [-1], [0], {}
    prefixes, last = [], 0
    for c in words:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        word.append(-1)
        to.append(0)
        p, q = last, -1
        while p >= 0:
            first = word[p]
            if first == c:
                q = to[p]
                break
            if first < 0:
                word[p], to[p] = c, new
            else:
                others = more.get(p)
                if others is None:
                    more[p] = {c: new}
                elif c in others:
                    q = others[c]
                    break
                else:
                    others[c] = new
            p = link[p]
        if q >= 0:
            if length[q] != length[p] + 1:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                word.append(word[q])
                to.append(to[q])
                if q in more:
                    more[copy] = dict(more[q])
                while p >= 0:
                    if word[p] == c:
                        if to[p] != q:
                            break
                        to[p] = copy
                    elif more[p][c] == q:
                        more[p][c] = copy
                    else:
                        break
                    p = link[p]
                link[q] = copy
                q = copy
            link[new] = q
        prefixes.append(new)
        last = new
    return length, link, prefixes


def heavy_heads(length: list[int], link: list[int]) -> list[int]:
    """The top state of every state's heavy path; a path goes on to the child with the most states."""
    order = np.argsort(np.array(length), kind="stable").tolist()[1:]
    size = [1] * len(length)
    for v in reversed(order):
        size[link[v]] += size[v]
    heavy, most = [-1] * len(length), [0] * len(length)
    for v in order:
        u = link[v]
        if size[v] > most[u]:
            most[u], heavy[u] = size[v], v
    head = list(range(len(length)))
    for v in order:
        u = link[v]
        if heavy[u] == v:
            head[v] = head[u]
    return head


def runs_of(words: list[int], least: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and ``periods`` periods, sorted."""
    length, link, prefixes = automaton(words)
    head = heavy_heads(length, link)
    # By path: (length of the deepest state, colour) of its segments, the uppermost last.
    segments: list = [None] * len(length)
    ends: dict = {}
    for i, v in enumerate(prefixes):
        below = -1  # colour that the path under this one begins with
        while v > 0:
            top, reach = head[v], length[v]
            stack = segments[top]
            if stack is None:
                segments[top] = [(reach, i)]
                below = -1
            else:
                first = stack[-1][1] if stack else -1
                while stack:
                    longest, colour = stack[-1]
                    if longest <= reach:
                        stack.pop()
                    else:
                        longest = reach
                    # A segment that began further down has been seen at its full length.
                    if colour != below:
                        period = i - colour
                        whole = longest + period
                        if whole >= periods * period and whole >= least and longest >= period:
                            ends[i - whole + 1, period] = i
                    if longest == reach:
                        break
                stack.append((reach, i))
                below = first
            v = link[top]
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def repeating(words: np.ndarray, least: int, window: int, cuts: int = CUTS) -> list[tuple[int, int]]:
    """(start, end) of stretches outside of which no run can be.

    Inside a run every window of ``window`` words occurs twice, a period apart. So a run lies in a
    stretch of successive windows that all recur in it. Windows meet by a hash; equal hashes
    of different windows only make a stretch longer.
    """
    todo, found = [(0, len(words), cuts)], []
    while todo:
        low, high, left = todo.pop()
        if high - low < least:
            continue
        if window < 1 or left == 0:
            found.append((low, high))
            continue
        n = high - low - window + 1
        hashed = np.zeros(n, dtype=np.int64)
        for shift in range(window):
            hashed = (hashed ^ (hashed >> 29)) * _ODD + words[low + shift : low + shift + n]
        order = np.argsort(hashed, kind="stable")
        same = hashed[order[1:]] == hashed[order[:-1]]
        if not same.any():
            continue
        again = np.zeros(n + 2, dtype=np.int8)
        again[order[1:][same] + 1] = 1
        again[order[:-1][same] + 1] = 1
        edges = np.diff(again)
        parts = [(low + a, low + b + window - 1) for a, b in zip(np.flatnonzero(edges > 0).tolist(), np.flatnonzero(edges < 0).tolist())]
        if parts == [(low, high)]:
            found += parts
        else:
            todo += [(a, b, left - 1) for a, b in parts]
    return found


def text_runs(words: list, least: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """``runs_of`` a text's words."""
    if len(words) < least:
        return []
    seen: dict = {}
    ids = [seen.setdefault(word, len(seen)) for word in words]
    if len(seen) == len(ids):
        return []
    window = least * (periods - 2) // periods
    runs = []
    for low, high in repeating(np.array(ids, dtype=np.int64), least, window):
        runs += [(low + start, length, period) for start, length, period in runs_of(ids[low:high], least, periods)]
    return sorted(runs)


def collapsed(words: list, runs: list) -> list:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = T.ArrayType(T.StructType().add("start", T.LongType()).add("length", T.LongType()).add("period", T.LongType()))


def periodic_runs(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST_LENGTH,
    periods: int = LEAST_PERIODS,
    arrange: Callable | None = None,
) -> DataFrame:
    """``key``, ``runs`` and ``collapsed``, one row per row of ``df``.

    A run is a stretch of consecutive words with smallest period p, at least ``least`` words and
    ``periods`` (2 or more) times p long, that no neighbouring word extends; runs are sorted by start, then
    period. ``collapsed`` is the words outside of repeats, joined by single spaces. Words are
    runs of anything but ASCII white space. ``arrange(key, words)`` may change the words first.

    A null text counts as empty: no runs, collapsed empty; an empty table gives an empty table;
    repeated ids and rows are each searched. Other columns, whatever their names, are left out. A text
    takes memory in proportion to its longest repetitive stretch.
    """
    schema = df.select(key).schema.add("runs", RUNS).add("collapsed", T.StringType())

    def search(batches):
        for batch in batches:
            found, kept = [], []
            keys = batch.column(0).to_pylist() if arrange else [None] * len(batch)
            for own, value in zip(keys, batch.column(1).cast(pa.binary())):
                words = (value.as_py() or b"").split()
                if arrange:
                    words = arrange(own, words)
                runs = text_runs(words, least, periods)
                found.append([dict(zip(("start", "length", "period"), run)) for run in runs])
                kept.append(b" ".join(collapsed(words, runs)))
            columns = [batch.column(0), pa.array(found, pa.list_(_RUN)), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [key, "runs", "collapsed"])

    return df.select(F.col(key), F.col(text)).mapInArrow(tidy(search), schema)
