"""Exact substring deduplication by suffix arrays, on Spark.

Every string of ``LENGTH`` bytes holds an anchor that depends on its bytes alone, the
smallest hash among its short grams. Documents that share a string share the
anchor, and the bytes around an anchor hold every such string through it. Equal surroundings are
merged first; where surroundings differ around the same anchor, a suffix array of them,
sorted in two stages, and its adjacent common prefixes show which strings they share.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import parts_for, staged, union

LENGTH = 100
GRAM = 20
# Grams in a string: the smallest hash of each is an anchor.
GRAMS = LENGTH - GRAM + 1
BLOCK = 1 << 20
# Anchors held before a task merges equal surroundings and sends the rest.
HELD = 300_000
ANCHORS_EACH = 150_000
SURROUNDINGS_EACH = 10_000
# A gram with so many different surroundings, or with this share of all, is matched string by string.
HOT_GRAM = 20_000
HOT_SHARE = 1e-5

_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict = {}


def _tables_for(size: int):
    """Random words for bytes, and powers of the base and of its inverse."""
    if len(_tables.get("up", ())) < size:
        _tables["words"] = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            powers = np.full(size, base, dtype=np.uint64)
            powers[0] = 1
            _tables[name] = np.multiply.accumulate(powers)
    return _tables["words"], _tables["up"], _tables["down"]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(document, place, gram hash, surroundings' hash, left, right) of a run of documents.

    ``data`` holds the documents' bytes back to back. Places count from the document's
    start; the surroundings are all strings of which this gram is the smallest: they reach from ``left``
    bytes before it to ``right`` bytes after its start.
    """
    found = []
    words, up, down = _tables_for(BLOCK)
    step = BLOCK - LENGTH + 1
    for low in range(0, max(0, len(data) - LENGTH + 1), step):
        # One string starts at each of ``step`` places.
        block = data[low : low + BLOCK]
        sums = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(words[block] * up[: len(block)], out=sums[1:])
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(block) - GRAM + 1])
        # The place in the low bits breaks ties to the left and is read from the minimum.
        least, width = (grams & ~np.uint64(BLOCK - 1)) | np.arange(len(grams), dtype=np.uint64), 1
        while 2 * width <= GRAMS:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = GRAMS - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        first = np.append(0, np.flatnonzero(least[1:] != least[:-1]) + 1)
        last = np.append(first[1:], len(least)) - 1
        places = (least[first] & np.uint64(BLOCK - 1)).astype(np.int64)
        document = np.searchsorted(starts, places + low, side="right") - 1
        first = np.maximum(first, starts[document] - low)
        last = np.minimum(last, ends[document] - LENGTH - low)
        inside = first <= last
        places, document, first, last = (x[inside] for x in (places, document, first, last))
        around = _mixed((sums[last + LENGTH] - sums[first]) * down[first])
        left, right = places - first, last + LENGTH - places
        around = _mixed(around + grams[places] * np.uint64(_BASE) + (left * 256 + right).astype(np.uint64))
        found.append((document, places + low - starts[document], grams[places], around, left, right))
    if not found:
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(column) for column in zip(*found))


# Fields of an anchor, packed in binary columns of this order.
FIELDS = (("gram", "<u8"), ("around", "<u8"), ("doc", "<i8"), ("copy", "<i4"), ("place", "<u4"), ("left", "u1"), ("right", "u1"))
PACKED = "bucket int, " + ", ".join(f"{name} binary" for name, _ in FIELDS)
# A row is packed anchors of a bucket, or a span to remove, in any bucket.
SPAN = "span_doc long, span_copy int, start long, end long"
SCANNED = f"{PACKED}, {SPAN}"


def _column_names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _first_of_each(a: dict) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order (gram, surroundings, document, copy, place), and which of them are
    the first with their surroundings."""
    order = np.lexsort((a["place"], a["copy"], a["doc"], a["around"], a["gram"]))
    gram, around = a["gram"][order], a["around"][order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = (gram[1:] != gram[:-1]) | (around[1:] != around[:-1])
    return order, first


def _spans_of(a: dict, rows: np.ndarray) -> dict:
    place = a["place"][rows].astype(np.int64)
    return {
        "span_doc": a["doc"][rows],
        "span_copy": a["copy"][rows],
        "start": place - a["left"][rows],
        "end": place + a["right"][rows],
    }


def _merged(spans: dict) -> dict:
    """Spans sorted and joined where they touch."""
    order = np.lexsort((spans["start"], spans["span_copy"], spans["span_doc"]))
    doc, copy, start, end = (spans[n][order] for n in ("span_doc", "span_copy", "start", "end"))
    if not len(doc):
        return spans
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1])
    # Ends so far, made comparable across documents by the document's number.
    number = np.cumsum(new)
    reach = np.maximum.accumulate(number * (1 << 40) + end)
    new[1:] |= start[1:] + number[1:] * (1 << 40) > reach[:-1]
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(doc)) - 1
    return {"span_doc": doc[firsts], "span_copy": copy[firsts], "start": start[firsts], "end": reach[lasts] - number[lasts] * (1 << 40)}


def _read(batch: pa.RecordBatch):
    """The fields of a batch's anchors, in the order of ``FIELDS``, and its bytes."""
    texts = batch.column("text").cast(pa.binary()).fill_null(b"")
    if not len(texts):
        return None
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if offsets[-1] == offsets[0]:
        return None
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    document, place, gram, around, left, right = anchors(data, offsets[:-1], offsets[1:])
    doc = np.asarray(batch.column("doc"), dtype=np.int64)[document]
    copy = np.asarray(batch.column("copy"), dtype=np.int32)[document]
    fields = (gram, around, doc, copy, place.astype(np.uint32), left.astype(np.uint8), right.astype(np.uint8))
    return fields, data, offsets[:-1][document] + place


def hot_grams(docs: DataFrame, total: int) -> np.ndarray:
    """Hashes of the grams with very many different surroundings, sorted.

    Every task counts its surroundings of each gram, and leaves out counts so small that
    all of them together cannot make half a hot gram. At most 2 / ``HOT_SHARE`` grams are found.
    """
    limit = max(HOT_GRAM, total * HOT_SHARE)
    flushes = total // HELD + docs.rdd.getNumPartitions()
    least = max(1, int(limit / 2 / flushes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def send():
            pairs = np.unique(np.stack([np.concatenate(column) for column in zip(*held)], axis=1), axis=0)
            grams, counts = np.unique(pairs[:, 0], return_counts=True)
            many = counts >= least
            return _batch({"gram": grams[many].view(np.int64), "n": counts[many]}, "gram long, n long")

        with np.errstate(over="ignore"):
            for batch in batches:
                if (found := _read(batch)) is not None:
                    held.append(found[0][:2])
                    n_held += len(found[0][0])
                if n_held >= HELD:
                    yield send()
                    held, n_held = [], 0
            if n_held:
                yield send()

    counted = docs.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    hot = [row.gram for row in counted.filter(F.col("n") >= limit / 2).select("gram").collect()]
    return np.sort(np.array(hot, dtype=np.int64).view(np.uint64))


def _string_by_string(fields, data: np.ndarray, at: np.ndarray):
    """Each string around the given anchors as an anchor of its own, its hash being its gram."""
    gram, around, doc, copy, place, left, right = fields
    count = left.astype(np.int64) + right - LENGTH + 1
    row = np.repeat(np.arange(len(gram)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = at[row] - left[row] + step
    words, up, _ = _tables_for(BLOCK)
    own = np.zeros(len(row), dtype=np.uint64)
    for k in range(LENGTH):
        own += words[data[start + k]] * up[k]
    own = _mixed(own)
    zeros = np.zeros(len(row), dtype=np.uint8)
    first = place[row].astype(np.int64) - left[row] + step
    return own, own, doc[row], copy[row], first.astype(np.uint32), zeros, zeros + np.uint8(LENGTH)


def scan(docs: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """All anchors, packed by bucket, and spans of surroundings a task has met before.

    Around hot grams every string is dealt out by itself, so that no bucket holds them all.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def send():
            a = {name: np.concatenate([h[i] for h in held]) for i, (name, _) in enumerate(FIELDS)}
            order, first = _first_of_each(a)
            spans = _merged(_spans_of(a, order[~first]))
            yield _batch({**spans, "bucket": (spans["span_doc"] % buckets).astype(np.int32)}, SCANNED)
            kept = order[first]
            bucket = (a["gram"][kept] % np.uint64(buckets)).astype(np.int64)
            dealt = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[dealt], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cuts))
            columns = {"bucket": full}
            for name, kind in FIELDS:
                values = a[name][kept][dealt].astype(kind)
                columns[name] = [values[cuts[b] : cuts[b + 1]].tobytes() for b in full]
            yield _batch(columns, SCANNED)

        with np.errstate(over="ignore"):
            for batch in batches:
                if (found := _read(batch)) is None:
                    continue
                fields, data, at = found
                many = np.isin(fields[0], shared.value)
                parts = [tuple(f[~many] for f in fields)]
                # A limited number of strings at a time.
                for rows in np.array_split(np.flatnonzero(many), max(1, int(many.sum()) // (HELD // GRAMS))):
                    parts.append(_string_by_string(tuple(f[rows] for f in fields), data, at[rows]))
                for part in parts:
                    held.append(part)
                    n_held += len(part[0])
                    if n_held >= HELD:
                        yield from send()
                        held, n_held = [], 0
            if n_held:
                yield from send()

    return docs.mapInArrow(read, SCANNED)


def _batch(columns: dict, schema: str) -> pa.RecordBatch:
    """A record batch of ``schema``; columns that are not given are null."""
    n = len(next(iter(columns.values())))
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrays, names = [], []
    for part in schema.split(", "):
        name, kind = part.split()
        names.append(name)
        arrays.append(pa.array(columns[name], type=kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]))
    return pa.RecordBatch.from_arrays(arrays, names)


ASKED = "doc long, copy int, gram long, place int, left int, right int"
COMPARED = f"{SPAN}, {ASKED}"


def compare(scanned: DataFrame) -> DataFrame:
    """Spans of all but the first of equal surroundings, and, for grams with different ones,
    the place of each first. Spans that are known already pass through."""

    def join(table: pa.Table) -> pa.Table:
        known = table.filter(table.column("gram").is_null()).select(_column_names(SPAN))
        table = table.filter(table.column("gram").is_valid())
        a = {name: np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind) for name, kind in FIELDS}
        order, first = _first_of_each(a)
        spans = _merged(_spans_of(a, order[~first]))
        kept = order[first]
        _, inverse, counts = np.unique(a["gram"][kept], return_inverse=True, return_counts=True)
        kept = kept[counts[inverse] > 1]
        asked = {n: a[n][kept].astype(np.int32) for n in ("copy", "place", "left", "right")}
        asked |= {"doc": a["doc"][kept], "gram": a["gram"][kept].view(np.int64)}
        before = {name: np.asarray(known.column(name)) for name in known.column_names}
        return pa.Table.from_batches([_batch(columns, COMPARED) for columns in (before, spans, asked)])

    return scanned.groupBy("bucket").applyInArrow(join, COMPARED)


def suffix_array(text: np.ndarray, wanted: np.ndarray | None = None, depth: int = LENGTH) -> np.ndarray:
    """Places in the order of the ``depth`` or more bytes from there on, zeros past the end.

    Two stages: only suffixes smaller than their successors are sorted directly. The others
    follow from a scan through the buckets of first bytes: each place found puts the
    place before it, if that is larger than its successor, next in its own bucket. Where not
    all suffixes are ``wanted``, the result holds these and those that lead to them.
    """
    n = len(text)
    if not n:
        return np.empty(0, dtype=np.int64)
    # A run of equal bytes has the order of what follows it; the last suffix exceeds its empty successor.
    turn = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    at = turn[np.searchsorted(turn, np.arange(n))]
    smaller = np.append(text, 0)[at + 1].astype(np.int16) > text[at]
    smaller[at == n - 1] = False
    needed = np.ones(n, dtype=bool)
    if wanted is not None:
        # From each wanted place on up to the next suffix that is sorted directly.
        direct = np.append(np.flatnonzero(smaller), n - 1)
        asked = np.flatnonzero(wanted)
        stops = direct[np.searchsorted(direct, asked)]
        change = np.bincount(asked, minlength=n + 1) - np.bincount(stops + 1, minlength=n + 1)
        needed = np.cumsum(change)[:n] > 0
    direct = np.flatnonzero(smaller & needed)
    words = _words(text, depth)
    direct = direct[np.lexsort([words[direct + 8 * k] for k in reversed(range(-(-depth // 8)))])]

    counts = np.bincount(text[needed], minlength=256)
    heads = np.concatenate([[0], np.cumsum(counts)[:-1]])
    tails = heads + counts
    out = np.full(counts.sum(), -1, dtype=np.int64)
    sorted_directly = np.bincount(text[direct], minlength=256)
    low = 0
    for c in np.flatnonzero(sorted_directly):
        size = sorted_directly[c]
        out[tails[c] - size : tails[c]] = direct[low : low + size]
        low += size
    front = heads.copy()

    def put(places: np.ndarray):
        """Places in scan order go to the fronts of their buckets."""
        chars = text[places]
        order = np.argsort(chars, kind="stable")
        chars, places = chars[order], places[order]
        within = np.arange(len(places)) - np.searchsorted(chars, chars, side="left")
        out[front[chars] + within] = places
        front[:] += np.bincount(chars, minlength=256)

    # The last suffix comes before all others of its byte, as if an end mark had been scanned.
    if needed[n - 1]:
        put(np.array([n - 1]))
    induced = needed & ~smaller
    for c in np.flatnonzero(counts):
        done, whole = heads[c], False
        while not whole:
            # First the places put here by the scan, wave by wave, then those sorted directly.
            stop = front[c]
            whole = stop == done
            if whole:
                done, stop = tails[c] - sorted_directly[c], tails[c]
            before = out[done:stop] - 1
            before = before[before >= 0]
            before = before[induced[before]]
            if len(before):
                put(before)
            done = stop
    return out


def _words(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from every place on as one number, larger for larger strings."""
    padded = np.concatenate([text, np.zeros(depth + 16, dtype=np.uint8)]).astype(np.uint64)
    words = padded
    for width in (1, 2, 4):
        words = (words[:-width] << np.uint64(8 * width)) | words[width:]
    return words


def shared_windows(text: np.ndarray, begins: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Keys of windows equal to a window with a smaller key.

    ``text`` is pieces back to back, ``begins`` where they begin, with the end; ``keys``
    numbers every place. Adjacent common prefixes of ``LENGTH`` join suffixes to groups.
    """
    inside = np.arange(len(text)) + LENGTH <= np.repeat(begins[1:], np.diff(begins))
    order = suffix_array(text, inside)
    order = order[inside[order]]
    if len(order) < 2:
        return np.empty(0, dtype=np.int64)
    words = _words(text, LENGTH)
    one, other = order[:-1], order[1:]
    common = words[one + LENGTH - 8] == words[other + LENGTH - 8]
    for k in range(LENGTH // 8):
        common &= words[one + 8 * k] == words[other + 8 * k]
    firsts = np.flatnonzero(np.append(True, ~common))
    own = keys[order]
    least = np.minimum.reduceat(own, firsts)
    group = np.cumsum(np.append(True, ~common)) - 1
    return np.unique(own[own > least[group]])


AROUND = "bucket int, doc long, copy int, begin long, bytes binary"


def surroundings(docs: DataFrame, asked: DataFrame, buckets: int) -> DataFrame:
    """The bytes around the asked anchors, by bucket of their gram."""
    wanted = asked.groupBy("doc", "copy").agg(F.collect_list(F.struct("place", "gram", "left", "right")).alias("places"))
    wanted, _ = staged(wanted.select(F.col("doc").alias("d"), F.col("copy").alias("c"), "places"), "asked")
    texts = docs.join(wanted, (F.col("doc") == F.col("d")) & (F.col("copy") == F.col("c"))).select("doc", "copy", "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, copy, data, places in zip(batch.column("doc").to_pylist(), batch.column("copy").to_pylist(), texts, batch.column("places")):
                for place, gram, left, right in zip(*(f.to_pylist() for f in places.values.flatten())):
                    rows.append((gram % buckets, doc, copy, place - left, data[place - left : place + right]))
            columns = dict(zip(_column_names(AROUND), zip(*rows))) if rows else {"bucket": []}
            yield _batch(columns, AROUND)

    return texts.mapInArrow(cut, AROUND)


def sort_suffixes(around: DataFrame) -> DataFrame:
    """Spans of strings that surroundings of one bucket share with an earlier place."""

    def search(table: pa.Table) -> pa.Table:
        pieces = [np.frombuffer(b, dtype=np.uint8) for b in table.column("bytes").to_pylist()]
        doc, copy, begin = (np.asarray(table.column(n), dtype=np.int64) for n in ("doc", "copy", "begin"))
        sizes = np.array([len(p) for p in pieces])
        begins = np.concatenate([[0], np.cumsum(sizes)])
        # Documents by rank in the high bits, places in the low ones: order of appearance.
        ids, rank = np.unique(np.stack([doc, copy], axis=1), axis=0, return_inverse=True)
        offset = np.arange(begins[-1]) - np.repeat(begins[:-1], sizes) + np.repeat(begin, sizes)
        keys = np.repeat(rank.ravel().astype(np.int64), sizes) * (1 << 40) + offset
        found = shared_windows(np.concatenate(pieces), begins, keys)
        owner, start = ids[found >> 40], found & ((1 << 40) - 1)
        spans = {"span_doc": owner[:, 0], "span_copy": owner[:, 1], "start": start, "end": start + LENGTH}
        return pa.Table.from_batches([_batch(_merged(spans), SPAN)])

    return around.groupBy("bucket").applyInArrow(search, SPAN)


# Texts of repeated ids, as written, that are ordered in one task.
RANKED_BYTES = 16 << 20


def numbered(df: DataFrame, key: str, text: str) -> DataFrame:
    """doc, copy, text: rows that share an id are numbered by text, all others are copy 0.

    Null ids come before all others, as the smallest long.
    """
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("doc"), F.coalesce(text, F.lit("")).alias("text"))
    several = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    several, _ = staged(several.select(F.col("doc").alias("d")), "repeated_ids")
    if several.isEmpty():
        return rows.select("doc", F.lit(0).alias("copy"), "text")
    single = rows.join(several, F.col("doc") == F.col("d"), "left_anti").select("doc", F.lit(0).alias("copy"), "text")
    repeated, size = staged(rows.join(several, F.col("doc") == F.col("d"), "left_semi").select("doc", "text"), "repeated_rows")
    return single.unionByName(_ranked(repeated, parts_for(size, RANKED_BYTES)))


def _ranked(rows: DataFrame, parts: int) -> DataFrame:
    """doc, copy, text: the rows of a doc numbered from 1 by text, however many they are.

    Rows are dealt to ranges of (doc, text), equal ones by chance, and numbered inside each range; a doc's rows in
    the ranges before are counted and added.
    """
    ranged = rows.withColumn("salt", F.rand(0)).repartitionByRange(parts, "doc", "text", "salt")
    ranged, _ = staged(ranged.withColumn("range", F.spark_partition_id()), "ranged_rows")
    counts = ranged.groupBy("doc", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("doc").orderBy("range")) - F.col("n")
    before, _ = staged(counts.select(F.col("doc").alias("d"), F.col("range").alias("r"), earlier.alias("before")), "rows_before")
    inside = F.row_number().over(Window.partitionBy("doc", "range").orderBy("text", "salt"))
    met = ranged.withColumn("inside", inside).join(before, (F.col("doc") == F.col("d")) & (F.col("range") == F.col("r")))
    return staged(met.select("doc", (F.col("inside") + F.col("before")).cast("int").alias("copy"), "text"), "ranked_rows")[0]


REMOVALS = "doc long, copy int, starts array<long>, ends array<long>"


def removals(docs: DataFrame) -> DataFrame:
    """``REMOVALS``: the maximal spans that each document loses."""
    n = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # An anchor comes about every half window of grams.
    total = 2 * n // GRAMS
    buckets = parts_for(total, ANCHORS_EACH)
    met, _ = staged(compare(scan(docs, buckets, hot_grams(docs, total))), "met")
    spans = [met.filter("span_doc IS NOT NULL").select(*_column_names(SPAN))]
    asked = met.filter("doc IS NOT NULL").select(*_column_names(ASKED))
    around = surroundings(docs, asked, parts_for(asked.count(), SURROUNDINGS_EACH))
    spans.append(sort_suffixes(around))
    dealt = union(spans).withColumn("part", F.expr(f"pmod(xxhash64(span_doc, span_copy), {buckets})"))

    def gather(table: pa.Table) -> pa.Table:
        spans = {n: np.asarray(table.column(n), dtype=np.int64) for n in _column_names(SPAN)}
        spans = _merged(spans)
        ids, first = np.unique(np.stack([spans["span_doc"], spans["span_copy"]], axis=1), axis=0, return_index=True)
        offsets = pa.array(np.append(first, len(spans["start"])), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(spans[n], pa.int64())) for n in ("start", "end")]
        return pa.table([pa.array(ids[:, 0], pa.int64()), pa.array(ids[:, 1].astype(np.int32)), *lists], names=["doc", "copy", "starts", "ends"])

    return dealt.groupBy("part").applyInArrow(gather, REMOVALS)


DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def suffix_dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, ``DIGEST`` and ``kept``, the bytes that remain.

    A byte goes if a string of ``LENGTH`` bytes over it also starts earlier: in a smaller
    id, or earlier in the same document. Null text is empty. Null ids come first; of
    rows that share an id the smaller text is the earlier one, and of equal rows one keeps its text.
    Strings do not cross documents. An empty table gives an empty table. Grams and
    surroundings are matched by 64-bit hashes, shared strings inside them byte by byte.
    """
    docs = numbered(df, key, text)
    gone, _ = staged(removals(docs).select(F.col("doc").alias("d"), F.col("copy").alias("c"), "starts", "ends"), "removals")
    joined = docs.join(gone, (F.col("doc") == F.col("d")) & (F.col("copy") == F.col("c")), "left").select("doc", "text", "starts", "ends")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, data, starts, ends in zip(*(batch.column(n).to_pylist() for n in ("doc",)), texts, *(batch.column(n).to_pylist() for n in ("starts", "ends"))):
                kept, at = [], 0
                for start, end in zip(starts or (), ends or ()):
                    kept.append(data[at:start])
                    at = end
                kept = b"".join([*kept, data[at:]])
                rows.append((None if doc == -(2**63) else doc, len(data), len(data) - len(kept), len(starts or ()), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [key, *_column_names(DIGEST), "kept"])

    return joined.mapInArrow(cut, f"{key} long, {DIGEST}, kept binary")
