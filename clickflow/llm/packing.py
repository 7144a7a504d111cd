"""Packing token sequences by minimum bin slack.

Documents longer than a window fill windows of their own; what remains of each is shorter
than a window. Only the counts of the remaining lengths are planned: for each window a
bitset subset-sum search finds the multiset of lengths that fills it closest to capacity.
"""

import base64
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import parts_for, staged, tidy

CAPACITY = 1024
VOCABULARY = "byte_bpe_50k"
END_OF_DOCUMENT = 0
# Pieces of one length are numbered in buckets of about so many pieces.
BUCKET_ROWS = 5_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int"

_encoding = None


def encoder(name: str = VOCABULARY):
    """Ids of a text in a public byte-level vocabulary, from its rank table.

    The rank table gives the ids that the vocabulary's own ``tokenizers`` file gives, faster;
    a test compares the two.
    """
    global _encoding
    if _encoding is None:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        special = {"<|endoftext|>": len(ranks)}
        encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> list[int]:
            if "<|endoftext|>" in text:
                return encoding.encode(text, allowed_special="all")
            return encoding.encode_ordinary(text)

        _encoding = encode
    return _encoding


def cut(ids: np.ndarray, capacity: int = CAPACITY):
    """(start, length, crc32) of a document's pieces: whole windows, then what remains."""
    for start in range(0, len(ids), capacity):
        piece = ids[start : start + capacity]
        yield start, len(piece), zlib.crc32(piece.tobytes())


def pieces(df: DataFrame, buckets: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``PIECES`` of every document; null text is empty and gives the single end token."""

    def tokenize(batches):
        encode = encoder()
        for batch in batches:
            rows = []
            ids = batch.column(key).to_pylist()
            for doc, data in zip(ids, batch.column(text).cast(pa.binary()).to_pylist()):
                found = encode((data or b"").decode("utf-8", "replace"))
                found.append(END_OF_DOCUMENT)
                tokens = np.array(found, dtype="<u4")
                for start, length, crc in cut(tokens):
                    rows.append((doc, start, length, crc, len(tokens), zlib.crc32(f"{doc},{start},{crc}".encode()) % buckets))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64()] * 5 + [pa.int32()]
            names = [part.split()[0] for part in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(tidy(tokenize), PIECES)


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths whose sum comes closest to ``room`` without exceeding it.

    Bit s of a bitset says that some multiset sums to s. Counts enter in powers of two; the
    bitset before every such step is kept, and going back through them gives the counts.
    """
    full = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, take = min(counts[length], room // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((reached, length, take))
            reached |= (reached << (length * take)) & full
            left -= take
            take *= 2
        if reached >> room & 1:
            break
    at = reached.bit_length() - 1
    used: Counter = Counter()
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            used[length] += take
            at -= length * take
    return dict(used)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(multiset of lengths, how many windows hold it) until every piece is placed.

    The largest length left opens a window, and the best fill completes it; the pattern is
    repeated as long as its lengths last. Each pattern uses up one of at most ``capacity`` lengths
    nearly or wholly, so the plan is short whatever the counts are.
    """
    left = {length: n for length, n in counts.items() if n}
    out = []
    while left:
        first = max(left)
        rest = {**left, first: left[first] - 1}
        pattern = Counter(best_fill({k: n for k, n in rest.items() if n and k <= capacity - first}, capacity - first))
        pattern[first] += 1
        times = min(left[k] // n for k, n in pattern.items())
        out.append((dict(pattern), times))
        for k, n in pattern.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


SLOTS = "length long, low long, high long, each long, first_sequence long, base long"


def slots(windows: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of ``SLOTS``: pieces number low to high of a length go, ``each`` to a sequence,
    into the sequences from ``first_sequence`` on, at offset ``base`` and after."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for pattern, times in windows:
        base = 0
        for length, n in sorted(pattern.items(), reverse=True):
            rows.append((length, used[length], used[length] + n * times, n, sequence, base))
            used[length] += n * times
            base += length * n
        sequence += times
    return rows


def pack(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    Every document ends with id 0, also one of empty or null text; a null id stays null, and
    repeated rows are packed as often as they come. No sequence is longer than the capacity.
    The driver sees one count for each length, at most ``CAPACITY`` of them. Pieces of one
    length, even if all have it, are numbered by bucket: counts per bucket are
    summed up, and each bucket is ranked on its own.
    """
    spark = df.sparkSession
    buckets = parts_for(df.count(), BUCKET_ROWS)
    cut_up, _ = staged(pieces(df, buckets, key, text), "pieces")
    sizes, _ = staged(cut_up.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "sizes")
    counts = {row.length: row.n for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("passed"))
    placed = spark.createDataFrame(slots(plan(counts)), SLOTS)
    # Pieces that agree in all three are interchangeable, or of repeated rows.
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    numbered = cut_up.withColumn("place", F.row_number().over(order) - 1).join(offsets, ["length", "bucket"])
    numbered = numbered.withColumn("number", F.col("place") + F.col("passed")).drop("place", "passed", "bucket")
    # At most a few rows for each length: far below any broadcast bound.
    fits = (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    joined = numbered.join(F.broadcast(placed), "length").filter(fits)
    nth = F.col("number") - F.col("low")
    return joined.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first_sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
