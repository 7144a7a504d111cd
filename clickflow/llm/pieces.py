"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut where no piece can reach across; the distinct segments are exploded into
substrings of bounded length, joined with the piece table, grouped to one lattice a segment, and the
best paths are a fold over the edges of many segments together. Each chunk of documents then looks its segments up.
"""

import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.common import parts_for, small_side, staged

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
# Text to a chunk: documents that are in memory together, with the codes of their segments.
CHUNK_BYTES = 40 << 20
# Texts that agree in a column get chunks of their own from this share of all bytes on: at most 1,000 values do.
OWN_SHARE = 0.001
# Text whose distinct segments make one task's lattices: they are some twenty times their segments' size.
LATTICE_BYTES = 3 << 20
# What an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0


@cache
def _model(path: str):
    """(ordinary pieces as (piece, id, score), ids of byte pieces, bytes of every id, unknown id)."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(path))
    ordinary, byte_ids, spelled = [], {}, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        data = piece.replace(SPACE, " ").encode()
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            data = bytes([int(piece[1:-1], 16)])
        elif model.is_control(i):
            data = b""
        elif not model.is_unknown(i) and not model.is_unused(i):
            ordinary.append((piece, i, model.get_score(i)))
        spelled.append(data)
    return ordinary, byte_ids, spelled, model.unk_id()


@cache
def _segments(path: str) -> re.Pattern:
    """Segments that no piece crosses: spaces with the letters, or the other characters, behind them.

    Letters that stand beside other characters in a piece count as others. If pieces cross a
    cut even so, segments are whole words.
    """
    pieces = [piece for piece, _, _ in _model(path)[0]]
    others: set[str] = set()
    while True:
        letter = f"[^\\W\\d_{re.escape(''.join(sorted(others)))}]"
        is_letter = re.compile(letter).fullmatch
        mixed = {c for p in pieces for a, b in zip(p, p[1:]) if SPACE not in (a, b) and bool(is_letter(a)) != bool(is_letter(b)) for c in (a, b) if is_letter(c)}
        if not mixed or len(others) > 100:
            break
        others |= mixed
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("a piece has a space after another character")
    if mixed:
        return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
    return re.compile(f"{SPACE}*(?:{letter}+|(?:(?!{letter})[^{SPACE}])+)|{SPACE}+")


@cache
def _letters_hold(path: str) -> bool:
    """Whether a word of letters alone is one segment."""
    pattern = _segments(path)
    letters = {c for piece, _, _ in _model(path)[0] for c in piece if c.isalpha()}
    return all(pattern.findall(f"{SPACE}a{c}a") == [f"{SPACE}a{c}a"] for c in letters)


def _words(text: str) -> list[str]:
    """The space-separated words of a text. One space stands before each; more stay with it."""
    text = text.replace(SPACE, " ")
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [w[1:] if w[1:2] != " " else w for w in re.findall(" *[^ ]+| +", " " + text)]
    return text.split(" ")


def _cut(word: str, segments: re.Pattern, whole_letters: bool = False) -> list[str]:
    if whole_letters and word.isalpha():
        return [SPACE + word]
    whole = word if word[:2] == "  " else " " + word
    return segments.findall(whole.replace(" ", SPACE))


def lattice(segments: DataFrame, pieces: DataFrame, most: int) -> DataFrame:
    """Every edge of every segment: ``segment``, its columns, start, end, id.

    Substrings of at most ``most`` characters meet the pieces in an equi-join on a 64-bit hash, a far
    quicker key than text, and then have to be equal; the pieces' own hashes all differ. A
    character without a piece of its own gets an edge without an id.
    """
    # Edges meet again by their segment's number first: they are in its order as they are made.
    segments = segments.withColumn("number", F.monotonically_increasing_id())
    starts = segments.withColumn("size", F.length("segment")).withColumn("start", F.explode(F.sequence(F.lit(0), F.col("size") - 1)))
    spans = starts.withColumn("span", F.explode(F.sequence(F.lit(1), F.least(F.lit(most), F.col("size") - F.col("start")))))
    named = spans.withColumn("part", F.substring("segment", F.col("start") + 1, F.col("span")))
    hashed = pieces.select("piece", F.xxhash64("piece").alias("hash"), F.col("id").alias("piece_id"))
    met = named.withColumn("hash", F.xxhash64("part")).join(hashed, "hash", "left")
    met = met.withColumn("id", F.when(F.col("part") == F.col("piece"), F.col("piece_id")))
    edges = met.filter("id IS NOT NULL OR span = 1").withColumn("end", F.col("start") + F.col("span"))
    return edges.drop("part", "hash", "piece", "piece_id", "span", "size")


@cache
def _piece_edges(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(length, score) of the edge of every id, at its id + 1; at 0 those of an unknown character."""
    ordinary, _, spelled, _ = _model(path)
    lengths, scores = np.ones(len(spelled) + 1, np.int64), np.zeros(len(spelled) + 1)
    for piece, i, score in ordinary:
        lengths[i + 1], scores[i + 1] = len(piece), score
    scores[0] = min(score for _, _, score in ordinary) - UNKNOWN_PENALTY
    return lengths, scores


def _best_edges(which: np.ndarray, start: np.ndarray, end: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Numbers of the edges on the best path of every segment, segment after segment, by start.

    Edges are from ``start`` to ``end`` in segment ``which``. The best score of every place is
    folded over the edges by their ends, for all segments together. Of equal scores the longer
    last piece wins.
    """
    order = np.lexsort((start, which, end))
    which, start, end, score = (values[order] for values in (which, start, end, score))
    sizes = np.zeros(which.max(initial=-1) + 1, np.int64)
    sizes[which] = end  # the last value assigned stays, here the greatest
    # A place stands before each character of a segment and one at its end; edges lead from place to place.
    first = np.cumsum(sizes + 1) - sizes - 1
    source, target = first[which] + start, first[which] + end
    best, last = np.zeros(len(sizes) + sizes.sum()), np.zeros(len(sizes) + sizes.sum(), np.int64)
    for a, b in pairwise([*np.flatnonzero(np.diff(end, prepend=-1)).tolist(), len(end)]):
        ways, places = best[source[a:b]] + score[a:b], target[a:b]
        new = np.flatnonzero(np.diff(places, prepend=-1))
        top = np.maximum.reduceat(ways, new)
        best[places[new]] = top
        won = np.flatnonzero(ways == np.repeat(top, np.diff(new, append=b - a)))[::-1]
        last[places[won]] = a + won  # of equal ways the one with the smallest start is assigned last
    at, taken = first + sizes, [np.zeros(0, np.int64)]
    while len(at):
        taken.append(last[at])
        at = source[taken[-1][start[taken[-1]] > 0]]
    path = np.concatenate(taken)
    return order[path[np.argsort(source[path])]]


def best_paths(edges: DataFrame, carried: str, model: str) -> DataFrame:
    """segment, ``carried``, path: the (start, id) of the edges of the best path, in order.

    ``carried`` stands on one edge of each segment.
    """
    # An edge is one number to group and to send: its start, and its id + 1 or 0.
    edge = F.shiftleft(F.col("start").cast("long"), 32) + F.coalesce(F.col("id") + 1, F.lit(0))
    grouped = edges.groupBy("number", "segment").agg(F.collect_list(edge).alias("edges"), F.first(carried, ignorenulls=True).alias(carried))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, scores = _piece_edges(model)
        for batch in batches:
            lists = batch.column("edges")
            packed = lists.flatten().to_numpy()
            which = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            start, place = packed >> 32, packed & 0xFFFFFFFF
            path = _best_edges(which, start, start + lengths[place], scores[place])
            ids = pa.array(place[path] - 1, pa.int32(), mask=place[path] == 0)
            steps = pa.StructArray.from_arrays([pa.array(start[path], pa.int32()), ids], ["start", "id"])
            ends = np.cumsum(np.bincount(which[path], minlength=len(lists)))
            paths = pa.ListArray.from_arrays(pa.array([0, *ends.tolist()], pa.int32()), steps)
            yield pa.RecordBatch.from_arrays([batch.column("segment"), batch.column(carried), paths], ["segment", carried, "path"])

    kind = f"segment string, {carried} {edges.schema[carried].dataType.simpleString()}, path array<struct<start:int,id:int>>"
    return grouped.select("segment", carried, "edges").mapInArrow(fold, kind)


def codes(paths: DataFrame, byte_ids: dict[int, int], unknown: int) -> DataFrame:
    """The paths' ids; an unknown character becomes its bytes' pieces, or the unknown id."""
    spelled = F.array(*(F.lit(byte_ids.get(b, unknown)) for b in range(256)))

    def ids(e):
        data = F.hex(F.encode(F.substring("segment", e["start"] + 1, F.lit(1)), "UTF-8"))
        bytes_ = F.transform(F.sequence(F.lit(0), (F.length(data) / 2 - 1).cast("int")), lambda i: F.conv(F.substring(data, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int"))
        fallback = F.transform(bytes_, lambda b: F.get(spelled, b)) if byte_ids else F.array(F.lit(unknown))
        return F.when(e["id"].isNotNull(), F.array(e["id"])).otherwise(fallback)

    known = F.forall("path", lambda e: e["id"].isNotNull())
    found = F.when(known, F.col("path")["id"]).otherwise(F.flatten(F.transform("path", ids)))
    return paths.withColumn("ids", found).drop("path")


def _chunk_ranges(docs: DataFrame) -> tuple[dict, tuple[int, int]]:
    """(first chunk, number of chunks) for large values of ``alike``, and for all other rows."""
    sizes = docs.groupBy("alike").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size"))
    sizes, _ = staged(sizes, "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    ranges, at = {}, 0
    own = sizes.filter(F.col("size") >= max(CHUNK_BYTES, OWN_SHARE * total)).filter("alike IS NOT NULL")
    for row in own.orderBy("alike").collect():
        ranges[row.alike] = (at, parts_for(row["size"], CHUNK_BYTES))
        at += ranges[row.alike][1]
        total -= row["size"]
    return ranges, (at, parts_for(total, CHUNK_BYTES))


PACKED = "chunk int, docs binary"


def _packed(df: DataFrame, ranges: dict, rest: tuple[int, int]) -> DataFrame:
    """Documents of a chunk as compressed record batches of (doc, text), chunk after chunk in a task."""

    def chunk_of(doc, size, alike):
        first, n = ranges.get(alike, rest)
        return first + zlib.crc32(f"{doc}".encode(), size) % n

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            sizes = pa.compute.binary_length(texts).fill_null(0).to_pylist()
            place = pa.array(map(chunk_of, batch.column("doc").to_pylist(), sizes, batch.column("alike").to_pylist()), pa.int32())
            out = []
            for chunk in place.unique().to_pylist():
                rows = pa.RecordBatch.from_arrays([batch.column("doc"), texts], ["doc", "text"]).filter(pa.compute.equal(place, chunk))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                    writer.write_batch(rows)
                out.append((chunk, sink.getvalue().to_pybytes()))
            columns = list(zip(*out)) if out else [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], ["chunk", "docs"])

    first, n = rest
    return df.mapInArrow(pack, PACKED).repartition(first + n, "chunk").sortWithinPartitions("chunk")


def _unpacked(blob) -> Iterator[tuple[int | None, str]]:
    for batch in pa.ipc.open_stream(blob):
        for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield doc, (data or b"").decode("utf-8", "replace")


def _chunk_segments(packed: DataFrame, model: str) -> DataFrame:
    """chunk, segment: the distinct segments of each chunk."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, whole_letters = _segments(model), _letters_hold(model)
        current, words = None, set()

        def done() -> Iterator[pa.RecordBatch]:
            found: set[str] = set()
            while words:
                found.update(_cut(words.pop(), pattern, whole_letters))
            while found:
                part = [found.pop() for _ in range(min(len(found), 50_000))]
                yield pa.RecordBatch.from_arrays([pa.array([current] * len(part), pa.int32()), pa.array(part, pa.string())], ["chunk", "segment"])

        for batch in batches:
            for chunk, blob in zip(batch.column("chunk"), batch.column("docs")):
                if chunk.as_py() != current:
                    yield from done()
                    current = chunk.as_py()
                for _, text in _unpacked(blob.as_buffer()):
                    words.update(_words(text))
        yield from done()

    return packed.mapInArrow(collect, "chunk int, segment string")


ENCODED = "n_tokens long, ids array<int>, round_trip boolean"


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", alike: str | None = None, model: str = MODEL) -> DataFrame:
    """One row per input row: ``key`` and ``ENCODED``.

    ``alike`` names a column, such as the language, whose values have words in common: large values
    get chunks of their own, so that fewer segments travel. It changes no result.

    The ids are those of the best-scoring segmentation of the text with a space put before it
    and every space written as the space sign; ``round_trip`` says that decoding gives the text
    back. It does unless the text has that sign itself, which reads back as a space. Null and
    empty texts have no ids; repeated rows are encoded each, and null keys stay null.
    """
    spark = df.sparkSession
    ordinary, byte_ids, spelled, unknown = _model(model)
    most = max(len(piece) for piece, _, _ in ordinary)
    # The table is the model's, not the data's; its size is checked like any other.
    table = small_side(spark.createDataFrame([piece[:2] for piece in ordinary], "piece string, id int"), "pieces")
    group = F.lit(None).cast("string") if alike is None else F.col(alike).cast("string")
    docs = df.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), group.alias("alike"))
    ranges, rest = _chunk_ranges(docs)
    packed = _packed(docs, ranges, rest)
    size = sum(n for _, n in (*ranges.values(), rest)) * CHUNK_BYTES
    # A segment's list of chunks stays in one cell: at most one small number for each chunk.
    segments = _chunk_segments(packed, model).repartition(parts_for(size, LATTICE_BYTES), "segment").groupBy("segment").agg(F.collect_list("chunk").alias("chunks"))
    edges = lattice(segments, table, most)
    once = F.when((F.col("start") == 0) & (F.col("end") == 1), F.col("chunks"))
    found = codes(best_paths(edges.withColumn("chunks", once), "chunks", model), byte_ids, unknown)
    known = found.select(F.explode("chunks").alias("part"), "segment", "ids")

    def look_up(docs: pa.Table, known: pa.Table) -> pa.Table:
        pattern, whole_letters = _segments(model), _letters_hold(model)
        ids = known.column("ids").combine_chunks()
        ends, values = (4 * ids.offsets.to_numpy()).tolist(), ids.values.to_numpy().astype("<i4").tobytes()
        numbers = memoryview(values).cast("i")
        code: dict[str, bytes] = {}
        lost: set[str] = set()  # segments that do not read back, and words that hold one
        for segment, a, b in zip(known.column("segment").to_pylist(), ends, ends[1:]):
            code[segment] = values[a:b]
            if b"".join([spelled[i] for i in numbers[a // 4 : b // 4]]) != segment.replace(SPACE, " ").encode():
                lost.add(segment)
        by_word: dict[str, bytes] = {}
        altered: set[str] = set()
        keys, encoded, whole = [], [], []
        for blob in docs.column("docs").to_pylist():
            for doc, content in _unpacked(blob):
                out = []
                for word in _words(content):
                    data = by_word.get(word)
                    if data is None:
                        cut = _cut(word, pattern, whole_letters)
                        data = by_word[word] = b"".join([code[s] for s in cut])
                        if lost and not lost.isdisjoint(cut):
                            altered.add(word)
                    out.append(data)
                keys.append(doc)
                encoded.append(b"".join(out))
                # The text is its words, each read back above, unless it has the sign itself.
                whole.append(SPACE not in content and not (altered and altered.intersection(_words(content))))
        ends = [0]
        for data in encoded:
            ends.append(ends[-1] + len(data) // 4)
        flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(encoded))])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
        sizes = pa.array([len(data) // 4 for data in encoded], pa.int64())
        return pa.table([pa.array(keys, pa.int64()), sizes, lists, pa.array(whole, pa.bool_())], names=["doc", "n_tokens", "ids", "round_trip"])

    joined = packed.groupBy("chunk").cogroup(known.groupBy("part")).applyInArrow(look_up, f"doc long, {ENCODED}")
    return joined.withColumnRenamed("doc", key)


def decode_ids(ids, spelled: list[bytes]) -> str:
    text = b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


def decode(df: DataFrame, ids: str = "ids", text: str = "text", model: str = MODEL) -> DataFrame:
    """``df`` with ``text``, spelled out from ``ids``; null ids give null, no ids empty text.

    Control ids are silent; ids outside the table fail the job.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = _model(model)[2]
        for batch in batches:
            texts = [None if row is None else decode_ids(row, spelled) for row in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text])

    return df.mapInArrow(spell, schema)
