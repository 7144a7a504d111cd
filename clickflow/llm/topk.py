"""Exact top-k search by inner product: a ball tree per shard, branch and bound.

Vectors are dealt to shards of bounded size. Each shard's tree answers the shard's own queries
first; the k-th scores found there travel with the queries to all other shards, where a node
whose bound is below the current k-th score is never opened, and a whole shard is
skipped if its root is.
"""

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import parts_for, staged

SHARD_ROWS = 4096
LEAF_ROWS = 128
# Query blocks, one from each shard, that meet a shard in one task.
BLOCKS_AT_ONCE = 32
# Sums below this are exact in double precision.
EXACT = 2.0**53
LONGS = (-(2**63), 2**63 - 1)


class BallTree:
    """Points in tree order, and each node's centre, radius, range, smallest id and children."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.lexsort((ids,))
        self.ids, self.points = ids[order], points[order]
        self.nodes: list = []
        self.leaf_rows = leaf_rows
        self._build(0, len(ids))
        self.centres = np.array([n[0] for n in self.nodes])
        self.radii = np.array([n[1] for n in self.nodes])

    def _build(self, low: int, high: int) -> int:
        """Splits at the median along the line through two far points, depth by the halving."""
        own = self.points[low:high].astype(np.float64)
        centre = own.mean(axis=0)
        away = ((own - centre) ** 2).sum(axis=1)
        radius = float(np.sqrt(away.max()))
        me = len(self.nodes)
        self.nodes.append([centre, radius, low, high, int(self.ids[low:high].min()), None])
        if high - low > self.leaf_rows and radius > 0:
            one = own[away.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            along = own @ (other - one)
            order = np.argsort(along, kind="stable")
            self.ids[low:high] = self.ids[low:high][order]
            self.points[low:high] = self.points[low:high][order]
            middle = (low + high) // 2
            self.nodes[me][5] = (self._build(low, middle), self._build(middle, high))
        return me

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For every query and node, a number that no inner product in the node exceeds."""
        reals = queries.astype(np.float64)
        sizes = np.sqrt((reals**2).sum(axis=1))[:, None]
        bound = reals @ self.centres.T + sizes * self.radii
        # Rounding may not hide a point: a margin well above it.
        return bound + 1e-9 * (np.abs(bound) + sizes * (self.radii + np.sqrt((self.centres**2).sum(axis=1)))) + 1e-9

    def search(self, own_id: int, query: np.ndarray, bounds: np.ndarray, k: int, best: list) -> list:
        """The k best (score, -id) of ``best`` and this tree, without ``own_id``; ``best`` is a heap."""
        queue = [(-bounds[0], 0)]
        while queue:
            bound, at = heapq.heappop(queue)
            if len(best) == k and -bound < best[0][0]:
                break
            _, _, low, high, smallest, children = self.nodes[at]
            if len(best) == k and -smallest < best[0][1] and -bound < best[0][0] + 1:
                continue  # it could only tie, and its ids are larger
            if children:
                for child in children:
                    heapq.heappush(queue, (-bounds[child], child))
                continue
            scores = self.points[low:high] @ query
            held = self.ids[low:high] != own_id
            if len(best) == k:
                held &= scores >= best[0][0]
            where = np.flatnonzero(held)
            if len(where) > k:
                where = where[np.lexsort((self.ids[low:high][where], -scores[where]))[:k]]
            for i in where:
                entry = (int(scores[i]), -int(self.ids[low + i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                else:
                    heapq.heappushpop(best, entry)
        return best


def _exact(points: np.ndarray) -> np.ndarray:
    """Doubles if every inner product is then exact, else Python integers."""
    most = np.abs(points).max(initial=0)
    return points if most * most * max(1, points.shape[1]) < EXACT else _integers(points)


def _integers(points):
    return np.array([[int(x) for x in row] for row in points], dtype=object).reshape(points.shape)


def _matrix(vectors, size: int) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors]).reshape(len(vectors), size)


VECTORS = "dim int, shard int, vec_id long, vector array<double>"
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", copies: int = 1) -> DataFrame:
    """vec_id, vector: floor(256 * x) of every component, without rows that take no part.

    Those have a null id, a null vector, or a null or non-finite component. Of rows that are the same in
    both, ``copies`` stay at most: a list of as many best ones has no place for more. The
    numbers are whole, and held as doubles.
    """
    grown = F.transform(F.col(vector), lambda x: F.rint(F.floor(x.cast("double") * 256).cast("double")))
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~bad)
    rows = rows.select(F.col(key).cast("long").alias("vec_id"), grown.alias("vector"))
    counted = rows.groupBy("vec_id", "vector").agg(F.least(F.count(F.lit(1)), F.lit(copies)).cast("int").alias("n"))
    return counted.select("vec_id", "vector", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).drop("copy")


def top_k(df: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query.

    Queries are the rows whose id is divisible by ``every``; all rows of other ids and the same
    length are candidates, ties go to the smaller id, and fewer candidates give fewer rows. Every
    row of a repeated id is a candidate of its own; where a query's id is repeated, its rows
    share one list of the ``k`` best pairs.
    Scores beyond a long are cut to its range. An empty table gives an empty table.
    """
    vectors, _ = staged(integer_vectors(df, key, vector, k), "vectors")
    sizes = vectors.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("dim", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"))
    dealt = vectors.withColumn("dim", F.size("vector")).join(sizes, "dim")
    dealt = dealt.withColumn("shard", F.expr("CAST(pmod(xxhash64(vec_id, vector), shards) AS INT)"))
    # One shard is one row of arrays from here on, of bounded size.
    rows = F.sort_array(F.collect_list(F.struct("vec_id", "vector")))
    shards = dealt.groupBy("dim", "shards", "shard").agg(rows.alias("rows"))
    shards = shards.select("dim", "shards", "shard", F.col("rows.vec_id").alias("ids"), F.flatten("rows.vector").alias("points"))
    shards, _ = staged(shards, "shards")

    def tree_of(row) -> BallTree:
        points = np.asarray(row.points, dtype=np.float64).reshape(len(row.ids), row.dim)
        return BallTree(np.asarray(row.ids, dtype=np.int64), _exact(points))

    def at_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                tree = tree_of(row)
                asked = np.flatnonzero(tree.ids % every == 0)
                if not len(asked):
                    continue
                bounds = tree.bounds(tree.points[asked])
                best = [tree.search(int(tree.ids[i]), tree.points[i], b, k, []) for i, b in zip(asked, bounds)]
                yield pd.DataFrame(
                    {
                        "dim": row.dim,
                        "shards": row.shards,
                        "home": row.shard,
                        "ids": [[int(i) for i in tree.ids[asked]]],
                        "points": [tree.points[asked].astype(np.float64).ravel()],
                        "scores": [[_score(s) for b in best for s, _ in _padded(b, k)]],
                        "found": [[-i for b in best for _, i in _padded(b, k)]],
                    }
                )

    home = "dim int, shards int, home int, ids array<long>, points array<double>, scores array<long>, found array<long>"
    blocks, _ = staged(shards.mapInPandas(at_home, home), "query_blocks")

    # Every block meets every other shard: both sides are sent out by shard and chunk of blocks.
    chunk = F.floor(F.col("home") / BLOCKS_AT_ONCE).cast("int")
    asking = blocks.select("*", chunk.alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    asking = asking.filter("shard <> home")
    chunks = F.sequence(F.lit(0), F.floor((F.col("shards") - 1) / BLOCKS_AT_ONCE).cast("int"))
    holding = shards.filter("shards > 1").select("*", F.explode(chunks).alias("chunk"))

    def abroad(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in held.itertuples():
            if not len(asked):
                continue
            tree = tree_of(row)
            for block in asked.itertuples():
                points = np.asarray(block.points, dtype=np.float64).reshape(len(block.ids), row.dim)
                queries = points if tree.points.dtype != object else _integers(points)
                if queries.dtype != object and len(queries):
                    most = np.abs(queries).max(initial=0) * np.abs(tree.points).max(initial=0) * max(1, row.dim)
                    if most >= EXACT:
                        queries, tree.points = _integers(queries), _integers(tree.points)
                bounds = tree.bounds(points)
                scores = np.asarray(block.scores).reshape(-1, k)
                found = np.asarray(block.found).reshape(-1, k)
                for i, query_id in enumerate(block.ids):
                    best = [(int(s), -int(v)) for s, v in zip(scores[i], found[i]) if v != _NONE]
                    heapq.heapify(best)
                    known = Counter(best)
                    best = Counter(tree.search(int(query_id), queries[i], bounds[i], k, best))
                    out += [(int(query_id), -v, _score(s)) for s, v in (best - known).elements()]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ("dim", "shard", "chunk")
    others = holding.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(abroad, FOUND)
    entry = F.arrays_zip(
        F.flatten(F.transform("ids", lambda i: F.array_repeat(i, k))).alias("query_id"), F.col("found").alias("vec_id"), F.col("scores").alias("score")
    )
    own = blocks.select(F.inline(entry)).filter(F.col("vec_id") != _NONE)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = own.unionByName(others).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# Fills up the list of a query that has found fewer than k; no id is kept under it.
_NONE = LONGS[0]


def _padded(best, k):
    return [*best, *[(0, -_NONE)] * (k - len(best))]


def _score(score) -> int:
    return min(max(int(score), LONGS[0]), LONGS[1])
