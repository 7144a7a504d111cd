"""Near-duplicate join on word n-grams: exact Jaccard by rare-first prefix filtering.

A document is the set of its word shingles. Documents of equal sets are one class. Classes
meet on the shingles of their prefixes, rarest first; length, positional and suffix
filters drop pairs that cannot reach the similarity, and each pair left is verified once.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import components, parts_for, small_side, staged, tidy, union

WORDS = 5
# Two sets link if OVER * intersection >= UNDER * union: a similarity of 0.75 or more.
OVER, UNDER = 4, 3
# Counters of the frequency sketch: 4 million, whatever the number of shingles.
SKETCH_BITS = 22
CHUNK_BITS = 16
# Frequencies are kept as steps of an eighth of a power of two, which fit in a byte.
STEPS = 8
# Postings in one task, and postings of one shingle from which on its list is split.
POSTINGS_EACH = 400_000
HOT_POSTINGS = 20_000
# Partners of one set in one group of pairs, and bytes of sets that a task holds before it sends them.
PARTNERS = 256
SENT_BYTES = 16 << 20
# Pairs from which on a group's are compared in blocks, and the shingles of one side of a block.
DENSE_PAIRS = 10_000
BLOCK_SHINGLES = 200_000
# Parts of the shingle space whose counts bound the overlap of two sets.
RANGE_BITS = 6
MOST_WORDS_CACHED = 150_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= MOST_WORDS_CACHED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def shingles(text: bytes | None, width: int = WORDS) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles; a short text is one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b"\n".join(words), seed=len(words))], dtype=np.uint64)
    codes = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    with np.errstate(over="ignore"):
        total = codes[: len(codes) - width + 1].copy()
        for i in range(1, width):
            total = total * _ODD + codes[i : len(codes) - width + 1 + i]
        return np.unique(_mixed(total))


def _class_of(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes(), seed=1) - (1 << 63)


def needed_overlap(a: Column, b: Column) -> Column:
    """The least intersection of linked sets of these sizes: 3 / 7 of the sum, rounded up."""
    return F.ceil((a + b) * UNDER / (OVER + UNDER))


def _needed(a, b):
    return -(-(a + b) * UNDER // (OVER + UNDER))


def prefix_length(n: int) -> int:
    """How many of its rarest shingles a set needs so that it meets every linked set there."""
    return n - -(-n * UNDER // OVER) + 1


SIGNATURES = "doc_id long, n long, class long, ranges array<smallint>, chunk int, counts binary, digest long"


def signatures(df: DataFrame, key: str, text: str) -> DataFrame:
    """A row per document with its set's size, class, counts by range and its text's hash, and rows with
    each task's share of the frequency sketch, in which a task counts a shingle up to 255 times."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int16()), pa.int32(), pa.binary(), pa.int64()]
        names = [part.split()[0] for part in SIGNATURES.split(", ")]
        for batch in batches:
            sizes, classes, ranges, seen = [], [], [], []
            for data in batch.column(text).cast(pa.binary()).to_pylist():
                tokens = shingles(data)
                sizes.append(len(tokens))
                classes.append(_class_of(tokens) if len(tokens) else None)
                counts = np.bincount((tokens >> np.uint64(64 - RANGE_BITS)).astype(np.int64), minlength=1 << RANGE_BITS)
                ranges.append(np.minimum(counts, 32767).astype(np.int16) if len(tokens) else None)
                seen.append((tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.uint32))
            if seen:
                places, counts = np.unique(np.concatenate(seen), return_counts=True)
                sketch[places] += counts.astype(np.uint32)
            ids = batch.column(key).cast(pa.int64())
            empty = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())
            arrays = [ids, *(pa.array(v, t) for v, t in zip((sizes, classes, ranges), types[1:4])), *empty, batch.column("__digest")]
            yield pa.RecordBatch.from_arrays(arrays, names)
        if sketch.any():
            parts = np.minimum(sketch, 255).astype(np.uint8).reshape(-1, 1 << CHUNK_BITS)
            n = len(parts)
            none = [pa.nulls(n, t) for t in types[:4]]
            counts = pa.array([part.tobytes() for part in parts], pa.binary())
            yield pa.RecordBatch.from_arrays([*none, pa.array(range(n), pa.int32()), counts, pa.nulls(n, pa.int64())], names)

    rows = df.select(F.col(key).cast("long").alias(key), text, F.xxhash64(text).alias("__digest"))
    return rows.mapInArrow(tidy(scan), SIGNATURES)


def frequency_steps(sketch: DataFrame) -> np.ndarray:
    """The summed sketch as one byte per counter: a fixed 4 MB whatever the input."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << CHUNK_BITS, dtype=np.uint64)
        for counts in rows["counts"]:
            total += np.frombuffer(counts, dtype=np.uint8)
        steps = np.minimum(255, np.rint(STEPS * np.log2(1.0 + total))).astype(np.uint8)
        return pd.DataFrame({"chunk": rows["chunk"][:1], "steps": [steps.tobytes()]})

    summed = sketch.groupBy("chunk").applyInPandas(add, "chunk int, steps binary")
    out = np.zeros((1 << (SKETCH_BITS - CHUNK_BITS), 1 << CHUNK_BITS), dtype=np.uint8)
    for row in summed.collect():
        out[row.chunk] = np.frombuffer(row.steps, dtype=np.uint8)
    return out.ravel()


def _rank(tokens: np.ndarray, steps: np.ndarray) -> np.ndarray:
    return steps[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]


def _splits(steps: np.ndarray) -> np.ndarray:
    """Into how many lists the postings of shingles of this frequency go."""
    return (1 + 2.0 ** (steps / STEPS) / HOT_POSTINGS).astype(np.int64)


POSTINGS = "bucket int, tokens binary, classes binary, sizes binary, places binary"


def postings(df: DataFrame, text: str, shared, buckets: int) -> DataFrame:
    """Prefix shingles with class, size and place, packed by bucket. Copies that one task
    meets are sent once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, known, held, n_held = shared.value, set(), [], 0

        def packed():
            tokens, classes, sizes, places = (np.concatenate(column) for column in zip(*held))
            parts = _splits(_rank(tokens, steps).astype(np.float64))
            salt = (classes % parts.astype(np.uint64)) * _ODD
            bucket = (_mixed(tokens + salt) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = []
            for b in range(buckets):
                part = order[cuts[b] : cuts[b + 1]]
                if len(part):
                    rows.append((b, *(column[part].tobytes() for column in (tokens, classes, sizes, places))))
            names = [part.split()[0] for part in POSTINGS.split(", ")]
            columns = list(zip(*rows))
            arrays = [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, names)

        with np.errstate(over="ignore"):
            for batch in batches:
                for data in batch.column(text).cast(pa.binary()).to_pylist():
                    tokens = shingles(data)
                    n = len(tokens)
                    if not n or (own := _class_of(tokens)) in known:
                        continue
                    known.add(own)
                    first = np.lexsort((tokens, _rank(tokens, steps)))[: prefix_length(n)]
                    k = len(first)
                    held.append(
                        (
                            tokens[first],
                            np.full(k, own, dtype=np.int64).view(np.uint64),
                            np.full(k, n, dtype=np.uint32),
                            np.arange(k, dtype=np.uint32),
                        )
                    )
                    n_held += k
                    if n_held > POSTINGS_EACH:
                        yield packed()
                        held, n_held = [], 0
            if held:
                yield packed()

    return df.select(text).mapInArrow(tidy(scan), POSTINGS)


def _may_link(size_a, place_a, size_b, place_b):
    """Positional filter: if this is the first shingle that both share, enough may follow.
    With places inside the prefixes it implies the length filter."""
    return 1 + np.minimum(size_a - place_a - 1, size_b - place_b - 1) >= _needed(size_a, size_b)


# A pair has no shingle; a posting that must be looked at again has no right side.
MET = "shingle long, a long, b long, size long, place long"


def meet(packed: DataFrame, shared) -> DataFrame:
    """Neighbours in each shingle's list, ordered by size, that may link, and the lists that
    hold more than these pairs."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        tokens, classes = (np.frombuffer(b"".join(rows[c]), dtype=np.uint64) for c in ("tokens", "classes"))
        sizes, places = (np.frombuffer(b"".join(rows[c]), dtype=np.uint32).astype(np.int64) for c in ("sizes", "places"))
        order = np.lexsort((classes, sizes, tokens))
        tokens, classes, sizes, places = (x[order] for x in (tokens, classes, sizes, places))
        fresh = np.ones(len(tokens), dtype=bool)
        fresh[1:] = (tokens[1:] != tokens[:-1]) | (classes[1:] != classes[:-1])
        tokens, classes, sizes, places = (x[fresh] for x in (tokens, classes, sizes, places))
        same = tokens[1:] == tokens[:-1]
        near = same & _may_link(sizes[:-1], places[:-1], sizes[1:], places[1:])
        a, b = classes[:-1][near].view(np.int64), classes[1:][near].view(np.int64)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        _, list_of, lengths = np.unique(tokens, return_inverse=True, return_counts=True)
        long = (lengths[list_of] > 2) | (_splits(_rank(tokens, shared.value).astype(np.float64)) > 1)
        n = int(long.sum())
        return pd.DataFrame(
            {
                "shingle": pd.array([*[pd.NA] * len(pairs), *tokens[long].view(np.int64).tolist()], dtype="Int64"),
                "a": np.concatenate([pairs[:, 0], classes[long].view(np.int64)]),
                "b": pd.array([*pairs[:, 1].tolist(), *[pd.NA] * n], dtype="Int64"),
                "size": pd.array([*[pd.NA] * len(pairs), *sizes[long].tolist()], dtype="Int64"),
                "place": pd.array([*[pd.NA] * len(pairs), *places[long].tolist()], dtype="Int64"),
            }
        )

    return packed.groupBy("bucket").applyInPandas(join, MET)


def _filtered(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose counts by range leave room for the overlap: the suffix filter."""

    def of(name):
        return classes.select(F.col("class").alias(name), F.col("n").alias(f"n_{name}"), F.col("ranges").alias(f"ranges_{name}"))

    joined = pairs.join(of("a"), "a").join(of("b"), "b")
    most = F.aggregate(F.zip_with("ranges_a", "ranges_b", lambda x, y: F.least(x, y).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    # A count that fills its cell may stand for more.
    full = F.exists("ranges_a", lambda x: x >= 32767) | F.exists("ranges_b", lambda x: x >= 32767)
    return joined.filter(full | (most >= needed_overlap(F.col("n_a"), F.col("n_b")))).select("a", "b")


# A set on its way to a group; sets marked own are compared with the others of the group.
SENT = "group long, part int, own boolean, class long, tokens binary"


def _sets_by_group(routes: DataFrame, df: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """``SENT`` rows for routes (class, group, part, own).

    Each class's shingles are read again from one document's text, only for classes with
    routes, and sent straight to the groups that need them.
    """
    routes = routes.groupBy("class").agg(F.collect_list(F.struct("group", "part", "own")).alias("routes"))
    wanted = routes.join(classes.select("class", "doc_id"), "class")
    # Null ids are a value of their own here.
    wanted = small_side(wanted.select("class", F.col("doc_id").alias("__doc"), "routes"), "wanted")
    rows = df.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("text"))
    texts = rows.join(wanted, F.col("__key").eqNullSafe(F.col("__doc"))).select("class", "text", "routes")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SENT.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()]

        def packed(out):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for batch in batches:
            out, held = [], 0
            columns = (batch.column("class").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("routes"))
            for own, data, routes in zip(*columns):
                tokens = shingles(data)
                # Rows that share the id may hold another text, or the same one twice.
                if len(tokens) and _class_of(tokens) == own:
                    held += tokens.nbytes * len(routes.values)
                    out += [(*route, own, tokens.tobytes()) for route in zip(*(f.to_pylist() for f in routes.values.flatten()))]
                if held > SENT_BYTES:
                    yield packed(out)
                    out, held = [], 0
            if out:
                yield packed(out)

    return texts.mapInArrow(tidy(send), SENT)


def _linked(sent: DataFrame) -> DataFrame:
    """Links a < b between the own and the other sets of each group, compared in full."""

    def compare(group: pa.Table) -> pa.Table:
        own, others = {}, {}
        for mark, name, data in zip(*(group.column(c).to_pylist() for c in ("own", "class", "tokens"))):
            (own if mark else others)[name] = np.frombuffer(data, dtype=np.uint64)
        found = []
        if own and others:
            names = np.array(list(others), dtype=np.int64)
            sizes = np.array([len(x) for x in others.values()])
            tokens, starts = np.concatenate(list(others.values())), np.cumsum(sizes) - sizes
            for name, mine in own.items():
                at = np.minimum(np.searchsorted(mine, tokens), len(mine) - 1)
                shared = np.add.reduceat((mine[at] == tokens).astype(np.int64), starts)
                linked = (OVER * shared >= UNDER * (len(mine) + sizes - shared)) & (names != name)
                found += [(min(name, int(x)), max(name, int(x))) for x in names[linked]]
        columns = list(zip(*set(found))) if found else [(), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return sent.groupBy("group", "part").applyInArrow(compare, "a long, b long")


def verify(pairs: DataFrame, df: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """The linked ones of distinct pairs of classes (a < b).

    One side of a pair travels for each pair, the other once for each ``PARTNERS`` of its partners.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("parts"))
    part = F.expr("CAST(pmod(xxhash64(b), parts) AS INT)").alias("part")
    routes = pairs.join(counts, "a").select(F.col("b").alias("class"), F.col("a").alias("group"), part, F.lit(False).alias("own"))
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    own = counts.select(F.col("a").alias("class"), F.col("a").alias("group"), each, F.lit(True).alias("own"))
    return _linked(_sets_by_group(routes.unionByName(own), df, classes, key, text))


def dense_groups(apart: DataFrame) -> DataFrame:
    """main, own_parts, other_parts: main components that hold most of their lists' classes
    beside some others, too many to list the pairs of."""
    members = apart.select("main", "a", "size", (F.col("component") != F.col("main")).alias("outside")).distinct()
    alone = F.col("outside").cast("long")
    sums = members.groupBy("main").agg(
        F.count(F.lit(1)).alias("n"), F.sum(alone).alias("out"), F.sum("size").alias("size"), F.sum(alone * F.col("size")).alias("out_size")
    )
    dense = sums.filter(f"out > 0 AND 2 * out <= n AND out * n >= {DENSE_PAIRS}")
    own = F.ceil(F.col("out_size") / BLOCK_SHINGLES * 4).cast("int").alias("own_parts")
    return dense.select("main", own, F.ceil(F.col("size") / BLOCK_SHINGLES).cast("int").alias("other_parts"))


def verify_blocks(apart: DataFrame, dense: DataFrame, df: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """Links of the classes outside a dense group's main component to any class of the group.

    Blocks of them meet blocks of all in one task each; their pairs are never listed.
    """
    members = apart.select("main", "a", (F.col("component") != F.col("main")).alias("outside")).distinct().join(dense, "main")
    mine, theirs = (F.expr(f"pmod(xxhash64(a), {n})") for n in ("own_parts", "other_parts"))
    every = (F.explode(F.sequence(F.lit(0), F.col(n) - 1)) for n in ("own_parts", "other_parts"))
    other = members.withColumn("i", next(every)).withColumn("part", F.col("i") * F.col("other_parts") + theirs)
    own = members.filter("outside").withColumn("i", next(every)).withColumn("part", mine * F.col("other_parts") + F.col("i"))
    routes = [
        side.select(F.col("a").alias("class"), F.col("main").alias("group"), F.col("part").cast("int").alias("part"), F.lit(mark).alias("own"))
        for side, mark in ((own, True), (other, False))
    ]
    return _linked(_sets_by_group(routes[0].unionByName(routes[1]), df, classes, key, text))


def _labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Lists with each posting's component and its list's main one, if it has others too."""
    named = lists.join(labels, F.col("a") == F.col("node"), "left")
    named = named.select("shingle", "a", "size", "place", F.coalesce("component", "a").alias("component"))
    named, _ = staged(named, "labelled_lists")
    counts = named.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("size", "a", "place")).alias("one"))
    most = F.max(F.struct("n", "component", "one"))
    mains = counts.groupBy("shingle").agg(F.count(F.lit(1)).alias("parts"), most.alias("main")).filter("parts > 1")
    return named.join(mains.select("shingle", F.col("main.component").alias("main"), F.col("main.one").alias("one")), "shingle")


def _joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: the components of the named ones' graph, names replaced."""
    ends = links
    for end in ("a", "b"):
        side = labels.select(F.col("node").alias(end), F.col("component").alias(f"component_{end}"))
        ends = ends.join(side, end, "left").withColumn(f"component_{end}", F.coalesce(f"component_{end}", end))
    found = components(ends, "component_a", "component_b", "merged").withColumnRenamed("node", "old")
    fresh = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    every = labels.unionByName(fresh.withColumn("component", F.col("node")))
    every = every.join(found, F.col("component") == F.col("old"), "left")
    return small_side(every.select("node", F.coalesce("merged", "component").alias("component")), "labels")


def _candidate(left: Column, right: Column, size: Column, place: Column, other_size: Column, other_place: Column) -> Column:
    follow = F.least(size - place, other_size - other_place)
    return (left != right) & (follow >= needed_overlap(size, other_size))


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def class_components(df: DataFrame, docs: DataFrame, sketch: DataFrame, key: str, text: str) -> DataFrame:
    """node, component: classes that links connect, with the smallest of their component.

    In a list of many copies only neighbours are compared at first. What these connect
    need not be compared again: next, postings outside their list's main component meet one
    of its members, and then all members of other components that may link: in blocks,
    where the main component is most of a large group, else as pairs. So a group of
    near copies lists pairs in proportion to its size, and no link between components is lost.
    """
    shared = df.sparkSession.sparkContext.broadcast(frequency_steps(sketch))
    prefix = F.col("n") - F.ceil(F.col("n") * UNDER / OVER) + 1
    total = docs.agg(F.sum(prefix)).first()[0] or 0
    classes = docs.filter("n > 0").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("ranges").alias("ranges")
    )
    classes, _ = staged(classes, "classes")
    met, _ = staged(meet(postings(df, text, shared, parts_for(total, POSTINGS_EACH)), shared), "met")
    lists = met.filter("shingle IS NOT NULL")
    tested = []

    def linked(pairs: DataFrame, name: str) -> DataFrame | None:
        """The links among pairs that have not been tested yet, if there are any pairs."""
        for before in tested:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs, _ = staged(_filtered(pairs, classes), name)
        if pairs.isEmpty():
            return None
        tested.append(pairs)
        return staged(verify(pairs, df, classes, key, text), f"links_{name}")[0]

    found = linked(met.filter("shingle IS NULL").select("a", "b").distinct(), "neighbours")
    if found is None:
        found = df.sparkSession.createDataFrame([], "a long, b long")
    labels = small_side(components(found), "labels")
    if lists.isEmpty():
        return labels
    outside, _ = staged(_labelled(lists, labels).filter("component <> main"), "outside")
    one = F.col("one")
    chance = _candidate(F.col("component"), F.col("main"), F.col("size"), F.col("place"), one["size"], one["place"])
    found = linked(outside.filter(chance).select(*_ordered(F.col("a"), one["a"])).distinct(), "to_main")
    if found is not None:
        labels = _joined_labels(labels, found)
    joined, _ = staged(_labelled(lists, labels), "lists_apart")
    dense, _ = staged(dense_groups(joined), "dense_groups")
    links = []
    if not dense.isEmpty():
        links.append(staged(verify_blocks(joined, dense, df, classes, key, text), "links_in_blocks")[0])
        joined = joined.join(dense, "main", "left_anti")
    others = joined.select("shingle", *(F.col(c).alias(f"{c}_2") for c in ("a", "component", "size", "place")))
    pairs = joined.filter("component <> main").join(others, "shingle").filter(
        _candidate(F.col("component"), F.col("component_2"), F.col("size"), F.col("place"), F.col("size_2"), F.col("place_2"))
    )
    found = linked(pairs.select(*_ordered(F.col("a"), F.col("a_2"))).distinct(), "across")
    links += [] if found is None else [found]
    return _joined_labels(labels, union(links)) if links else labels


def _members(df: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, digest, n_shingles, label, component_id for every row; see ``near_duplicates``.

    ``digest`` is a hash of the row's text, ``label`` the smallest class of its component, null without words.
    """
    scanned, _ = staged(signatures(df, key, text), "signatures")
    docs = scanned.filter("chunk IS NULL").select("doc_id", "digest", "n", "class", "ranges")
    sketch = scanned.filter("chunk IS NOT NULL").select("chunk", "counts")
    labels = class_components(df, docs, sketch, key, text)
    member = docs.select("doc_id", "digest", "n", "class").join(labels, F.col("class") == F.col("node"), "left")
    member = member.select("doc_id", "digest", F.col("n").alias("n_shingles"), F.coalesce("component", "class").alias("label"))
    smallest, _ = staged(member.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("smallest")), "smallest")
    named = member.join(smallest, "label", "left")
    own = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return named.select("doc_id", "digest", "n_shingles", "label", own.alias("component_id"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    Words are runs of anything but ASCII white space, A-Z in lower case; shingles are five
    words, a shorter text is one shingle, and texts without words, null ones included, link
    with nothing. Component ids are the smallest non-null id that links reach; a null id is
    carried along, and without any other id its component is null. Repeated ids are rows of
    their own. An empty table gives an empty table. Shingles and classes are 64-bit hashes.
    """
    return _members(df, key, text).select("doc_id", "n_shingles", "component_id")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``df``, all columns, for each component: one whose id names it.

    Rows are told apart by id and text (its 64-bit hash), so rows that share an id but not a
    component do not share their fate, and of several texts of the naming id in one component
    the one with the smallest hash stays. Rows with a null id and texts without words stay.
    Of rows that agree in id and text one stays.
    """
    found, _ = staged(_members(df, key, text), "near_duplicates")
    linked = found.filter("label IS NOT NULL AND doc_id IS NOT NULL")
    naming = linked.filter("doc_id = component_id")
    # Only where the naming id has several texts in its component does the hash decide.
    texts = naming.groupBy("label").agg(F.min("digest").alias("first"), F.max("digest").alias("last")).filter("first <> last")
    others = naming.join(small_side(texts, "first_texts"), "label").filter("digest <> first")
    gone = linked.filter("doc_id <> component_id").select("doc_id", "digest").unionByName(others.select("doc_id", "digest"))
    gone = small_side(gone.select(F.col("doc_id").alias("__gone"), F.col("digest").alias("__gone_text")).distinct(), "gone")
    kept = df.join(gone, (F.col(key) == F.col("__gone")) & (F.xxhash64(text) == F.col("__gone_text")), "left_anti")
    repeated = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND doc_id IS NOT NULL")
    repeated, _ = staged(repeated.select(F.col("doc_id").alias("__id")), "repeated")
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, F.col(key) == F.col("__id"), "left_anti")
    several = kept.join(repeated, F.col(key) == F.col("__id"), "left_semi")
    return single.unionByName(several.dropDuplicates([key, text]))
