"""Whitening of embeddings by an incremental eigendecomposition.

Distinct vectors are dealt to shards of bounded size. In each shard vectors enter one by one: the
eigenvalues and eigenvectors of what has been seen so far are updated for one more centred vector
by solving the secular equation of a rank-one change, deflated where it changes nothing. Shards'
spectra then meet in small groups, one spectrum entering the other as successive rank-one
updates, until one is left. A Rayleigh-Ritz pass over all shards refines it: the covariance is
projected on the eigenvectors found, and the projection's own eigenvectors turn them.
"""

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import parts_for, small_side, staged, tidy

SHARD_ROWS = 4096
# Spectra or sums that meet in one task.
FAN_IN = 8
EPS = np.finfo(np.float64).eps
# A projected covariance is diagonal enough if nothing off its diagonal is above this share of its trace.
SETTLED = 1e-10
PASSES = 4
# An eigenvalue below this share of the largest one is rounding: there is no variance to scale by.
NO_VARIANCE = 1e-13


class Spectrum:
    """How many vectors were seen, their mean, and the eigenpairs of their scatter, ascending."""

    def __init__(self, size: int):
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def add(self, vector: np.ndarray) -> None:
        """One more vector: the scatter grows by (n - 1) / n times its centred square."""
        away = vector - self.mean
        self.n += 1
        self.mean = self.mean + away / self.n
        if self.n > 1:
            self.update((self.n - 1) / self.n, away)

    def merge(self, other: "Spectrum") -> None:
        """Another spectrum enters as one update for each of its eigenpairs and one for the means."""
        if not other.n:
            return
        away, n = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(value, vector)
        if self.n:
            self.update(self.n / n * other.n, away)
        self.n, self.mean = n, self.mean + away * (other.n / n)

    def update(self, weight: float, vector: np.ndarray) -> None:
        """The eigenpairs after ``weight`` times the square of ``vector`` is added."""
        z = vector @ self.vectors
        length = np.sqrt(z @ z)
        weight = weight * length * length
        if not weight > 0:
            return
        z = z / length
        d, q = self.values, self.vectors
        tolerance = 8 * EPS * max(np.abs(d).max(), weight)
        moved = np.flatnonzero(weight * np.abs(z) > tolerance)
        if not len(moved):
            return
        # Of two values that are all but equal one is rotated out of the update.
        gaps = d[moved[1:]] - d[moved[:-1]]
        if len(moved) > 1 and (gaps <= np.sqrt(tolerance * max(np.abs(d).max(), weight))).any():
            d, q, moved = self._rotated(d, q, z, moved, tolerance)
        values, turn = rank_one(d[moved], z[moved], weight)
        d, q = d.copy(), q.copy()
        d[moved], q[:, moved] = values, q[:, moved] @ turn
        order = np.argsort(d, kind="stable")
        self.values, self.vectors = d[order], q[:, order]

    @staticmethod
    def _rotated(d, q, z, moved, tolerance):
        """Deflation by rotations; ``z`` is changed in place."""
        d, q, kept = d.copy(), q.copy(), []
        for j in moved:
            if kept:
                i = kept[-1]
                length = np.hypot(z[i], z[j])
                c, s = z[j] / length, z[i] / length
                if abs((d[j] - d[i]) * c * s) <= tolerance:
                    # All of the length goes to j, none stays with i.
                    z[i], z[j] = 0.0, length
                    q[:, i], q[:, j] = c * q[:, i] - s * q[:, j], s * q[:, i] + c * q[:, j]
                    d[i], d[j] = c * c * d[i] + s * s * d[j], s * s * d[i] + c * c * d[j]
                    kept.pop()
            kept.append(j)
        return d, q, np.array(kept)


def rank_one(d: np.ndarray, z: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of diag(d) + weight * z z', d ascending and distinct, z without zeros.

    Roots are sought as distances from the nearer of their two poles, so that differences to all
    poles keep their relative precision; the eigenvectors come from the z that has these
    roots exactly, which makes them orthogonal.
    """
    k = len(d)
    if k == 1:
        return d + weight * z * z, np.ones((1, 1))
    at = np.arange(k)
    squares = weight * z * z
    right = np.append(d[1:], d[-1] + squares.sum())
    middle = (right - d) / 2
    # Origin of each root: the pole in whose half of the interval it lies; the last has one pole only.
    sums = 1 + (squares[:, None] / (d[:, None] - d[None, :] - middle[None, :])).sum(axis=0)
    upper = (sums < 0) & (at < k - 1)
    origin = np.where(upper, right, d)
    poles = d[:, None] - origin[None, :]
    low = np.where(upper, -middle, 0.0)
    high = np.where(upper, 0.0, np.where(at < k - 1, middle, 2 * middle))
    a, b = d - origin, np.append(d[1:], np.inf) - origin
    below = at[:, None] <= at[None, :]
    tau = (low + high) / 2
    for _ in range(80):
        away = poles - tau
        terms = squares[:, None] / away
        f = 1 + terms.sum(axis=0)
        bound = 1 + np.abs(terms).sum(axis=0)
        low, high = np.where(f < 0, tau, low), np.where(f >= 0, tau, high)
        open_ = (np.abs(f) > 2 * EPS * bound) & (high - low > 2 * EPS * np.abs(tau))
        if not open_.any():
            break
        slopes = terms / away
        left = np.where(below, slopes, 0.0).sum(axis=0)
        rest = slopes.sum(axis=0) - left
        step = _step(a - tau, b - tau, f, left, rest)
        new = tau + step
        inside = (new > low) & (new < high)
        tau = np.where(open_, np.where(inside, new, (low + high) / 2), tau)
    away = poles - tau  # d_i - root_j
    ratios = np.abs(away)
    between = np.abs(d[:, None] - d[None, :])
    np.fill_diagonal(between, 1.0)
    exact = np.sqrt(np.exp(np.log(ratios / between).sum(axis=1))) * np.sign(z)
    turn = exact[:, None] / away
    return origin + tau, turn / np.sqrt((turn * turn).sum(axis=0))


def _step(to_a, to_b, f, left, rest):
    """From every root's guess to the root of a sum of its two nearest poles with the same value and slopes."""
    with np.errstate(all="ignore"):
        # One pole: value and slope of c + s / (a - x).
        one = f - to_a * left
        single = to_a + to_a * to_a * left / one
        both = to_a * to_b
        p = (to_a + to_b) * f - both * (left + rest)
        q = both * f
        c = f - to_a * left - to_b * rest
        root = np.sqrt(np.maximum(p * p - 4 * q * c, 0.0))
        double = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
        step = np.where(np.isinf(to_b), single, double)
    return np.where(np.isfinite(step), step, np.inf)


def integers(vector: str) -> Column:
    """floor(256 * c) of every component as a long; beyond a long, its nearest end."""
    return F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * 256).cast("long"))


def integer_rows(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key``, ``__x`` and ``__dim`` of the rows that take part: no null vector, null or non-finite component."""
    bad = F.exists(F.col(vector), lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    rows = df.filter(F.col(vector).isNotNull() & ~bad)
    return rows.select(F.col(key), integers(vector).alias("__x")).withColumn("__dim", F.size("__x"))


SHARD = "dim int, part int, n long, points array<long>"
STATE = "dim int, part int, n long, sums array<decimal(38,0)>, mean array<double>, values array<double>, vectors array<double>"
PROJECTED = "dim int, part int, products array<double>"
MODEL = "dim int, n long, sums array<decimal(38,0)>, values array<double>, vectors array<double>, unsettled double"


def _shards(rows: DataFrame, shard_rows: int) -> tuple[DataFrame, int]:
    """The distinct vectors, a row for each shard of about ``shard_rows`` of them, and the most shards of a length."""
    fit, _ = staged(rows.select(F.col("__dim").alias("dim"), F.col("__x").alias("x")).filter("dim > 0").distinct(), "distinct_vectors")
    counted = small_side(fit.groupBy("dim").agg(F.count(F.lit(1)).alias("n")), "vector_lengths")
    most = parts_for(counted.agg(F.max("n")).first()[0] or 0, shard_rows)
    share = F.ceil(F.col("n") / shard_rows).cast("long")
    dealt = fit.join(counted, "dim")
    dealt = dealt.select("dim", "x", F.pmod(F.xxhash64("x"), share).cast("int").alias("part"))
    shards = dealt.groupBy("dim", "part").agg(F.count(F.lit(1)).alias("n"), F.flatten(F.collect_list("x")).alias("points"))
    return staged(shards, "vector_shards")[0], most


def _points(row) -> np.ndarray:
    return np.asarray(row.points, dtype=np.int64).reshape(row.n, row.dim)


def _state(row, spectrum: Spectrum, sums) -> tuple:
    return (row.dim, row.part, spectrum.n, list(sums), spectrum.mean, spectrum.values, spectrum.vectors.ravel())


def _spectrum(row) -> Spectrum:
    found = Spectrum(row.dim)
    found.n, found.mean, found.values = row.n, np.asarray(row.mean), np.asarray(row.values)
    found.vectors = np.asarray(row.vectors).reshape(row.dim, row.dim)
    return found


def _frame(rows, schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[part.split()[0] for part in schema.split(", ")])


def shard_spectra(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            points, spectrum = _points(row), Spectrum(row.dim)
            for vector in points.astype(np.float64):
                spectrum.add(vector)
            sums = [Decimal(sum(column)) for column in points.T.tolist()]
            yield _frame([_state(row, spectrum, sums)], STATE)


def _merged(states: pd.DataFrame) -> pd.DataFrame:
    rows = list(states.sort_values("part").itertuples())
    spectrum = _spectrum(rows[0])
    sums = np.array(rows[0].sums, dtype=object)
    for row in rows[1:]:
        spectrum.merge(_spectrum(row))
        sums = sums + np.array(row.sums, dtype=object)
    return _frame([_state(rows[0], spectrum, sums)], STATE)


def _added(products: pd.DataFrame) -> pd.DataFrame:
    first = products.iloc[0]
    return _frame([(first.dim, first.part, np.sum(products.sort_values("part")["products"].to_list(), axis=0))], PROJECTED)


def _folded(parts: DataFrame, most: int, merge, schema: str, name: str) -> DataFrame:
    """One row per length, made of ``most`` parts at most in rounds of ``FAN_IN`` each."""
    parts, _ = staged(parts, name)
    while most > 1:
        group = F.floor(F.col("part") / FAN_IN).cast("int")
        parts = parts.groupBy("dim", group.alias("__group")).applyInPandas(merge, schema)
        parts, _ = staged(parts.withColumn("part", group), name)
        most = parts_for(most, FAN_IN)
    return parts


def first_model(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merged spectra with their eigenvectors made orthonormal to the last digit."""
    for batch in batches:
        for row in batch.itertuples():
            vectors = np.linalg.qr(np.asarray(row.vectors).reshape(row.dim, row.dim))[0]
            yield _frame([(row.dim, row.n, list(row.sums), np.asarray(row.values) / row.n, vectors.ravel(), 1.0)], MODEL)


def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of every shard the sum of squares of its centred vectors in the model's directions."""
    for batch in batches:
        for row in batch.itertuples():
            mean = np.array([float(s / row.total) for s in row.sums])
            turned = (_points(row) - mean) @ np.asarray(row.vectors).reshape(row.dim, row.dim)
            yield _frame([(row.dim, row.part, (turned.T @ turned).ravel())], PROJECTED)


def refine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ritz values and vectors of the projected covariance, and how far from diagonal it was."""
    for batch in batches:
        for row in batch.itertuples():
            covariance = np.asarray(row.products).reshape(row.dim, row.dim) / row.n
            off = np.abs(covariance - np.diag(np.diag(covariance))).max()
            values, turn = np.linalg.eigh((covariance + covariance.T) / 2)
            vectors = np.linalg.qr(np.asarray(row.vectors).reshape(row.dim, row.dim) @ turn)[0]
            largest = np.abs(vectors).argmax(axis=0)
            vectors = vectors * np.sign(vectors[largest, np.arange(row.dim)])
            unsettled = off / max(np.trace(covariance), np.finfo(float).tiny)
            yield _frame([(row.dim, row.n, list(row.sums), np.maximum(values, 0.0), vectors.ravel(), unsettled)], MODEL)


def whitening_model(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """(the shards, a row of ``MODEL`` for each length of vectors) of what ``integer_rows`` gives.

    ``values`` are the covariance's eigenvalues, ascending, ``vectors`` the matrix whose columns
    are its eigenvectors, row by row. Their signs make the largest entry positive.
    """
    shards, most = _shards(rows, shard_rows)
    # Shards take far more time than their bytes tell: they are dealt to all cores in turn.
    dealt = shards.repartition(min(most, 8 * rows.sparkSession.sparkContext.defaultParallelism))
    states = _folded(dealt.mapInPandas(tidy(shard_spectra), STATE), most, _merged, STATE, "spectra")
    model, _ = staged(states.mapInPandas(tidy(first_model), MODEL), "whitening_model")
    for _ in range(PASSES):
        side = small_side(model.select("dim", F.col("n").alias("total"), "sums", "vectors"), "model_side")
        products = shards.join(side, "dim").mapInPandas(tidy(project), PROJECTED)
        products = _folded(products, most, _added, PROJECTED, "projected").select("dim", "products")
        model, _ = staged(model.join(products, "dim").mapInPandas(tidy(refine), MODEL), "whitening_model")
        worst = model.agg(F.max("unsettled")).first()[0]
        if worst is None or worst <= SETTLED:
            break
    return shards, model


TOP = "dim int, n long, sums array<decimal(38,0)>, mean array<double>, weights array<array<double>>, explained array<double>"


def _top(components: int):
    def top(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                k = min(components, row.dim)
                values = np.asarray(row.values)[::-1][:k]
                vectors = np.asarray(row.vectors).reshape(row.dim, row.dim)[:, ::-1][:, :k]
                trace = float(np.sum(row.values))
                weights = [list(v / np.sqrt(e)) if e > NO_VARIANCE * values[0] else None for e, v in zip(values, vectors.T)]
                explained = [e / trace if trace > 0 else None for e in values]
                mean = [float(s / row.n) for s in row.sums]
                yield _frame([(row.dim, row.n, list(row.sums), mean, weights, explained)], TOP)

    return top


def _whitened(x: Column) -> Column:
    """An array of the whitened components of ``x``, null where there is no variance."""
    centred = F.zip_with(x, F.col("mean"), lambda a, m: a.cast("double") - m)
    parts = F.transform("weights", lambda w: F.aggregate(F.zip_with(centred, w, lambda a, b: a * b), F.lit(0.0), lambda t, p: t + p))
    return parts


def _deviation(x: Column) -> Column:
    """The sum of (n * x - sum)^2, null beyond 38 digits."""
    exact = "decimal(38,0)"
    away = F.zip_with(x, F.col("sums"), lambda a, s: (F.col("n") * a.cast("decimal(20,0)") - s).try_cast(exact))
    squares = F.transform(away, lambda a: F.try_multiply(a, a).try_cast(exact))
    return F.aggregate(squares, F.lit(0).cast(exact), lambda t, s: F.try_add(t, s).try_cast(exact))


def whiten(
    df: DataFrame,
    components: int = 4,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``key``, component, n, deviation, whitened, explained and identity_error.

    A row for each row of ``df`` that takes part and each of the first ``components`` components,
    numbered from 1. The distinct vectors are what is fitted: copies, of which one vector may have
    any number, change nothing, and each gets rows of its own, also under a null or repeated ``key``.
    Vectors of different lengths are fitted apart; an empty vector has no component and so no
    row. A component without variance has a null ``whitened`` and ``explained`` 0, or null where
    nothing varies at all. ``deviation`` is exact, and null beyond 38 digits. Other columns,
    whatever their names, are left out; an empty table gives an empty table.
    """
    rows = integer_rows(df, key, vector)
    shards, model = whitening_model(rows, shard_rows)
    top, _ = staged(model.mapInPandas(tidy(_top(components)), TOP), "components")
    top = small_side(top.join(identity_error(shards, top, components), "dim", "left"), "components")
    side = top.withColumnRenamed("dim", "__length")
    found = rows.join(side, F.col("__dim") == F.col("__length"))
    # Both before the rows are multiplied by components.
    found = found.select(
        key,
        "n",
        _deviation(F.col("__x")).alias("deviation"),
        "identity_error",
        F.posexplode(F.arrays_zip(_whitened(F.col("__x")).alias("whitened"), "explained")).alias("__at", "__of"),
    )
    return found.select(
        key,
        (F.col("__at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("__of.whitened").alias("whitened"),
        F.col("__of.explained").alias("explained"),
        "identity_error",
    )


def identity_error(shards: DataFrame, top: DataFrame, components: int) -> DataFrame:
    """dim, identity_error: the largest entry of the covariance of the whitened distinct vectors
    minus the identity, over components that have variance."""
    side = small_side(top.select("dim", "mean", "weights"), "components_side")
    starts = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    each = shards.join(side, "dim").select("dim", "mean", "weights", F.explode(F.transform(starts, lambda i: F.slice("points", (i * F.col("dim") + 1).cast("int"), F.col("dim")))).alias("x"))
    scores = each.select("dim", _whitened(F.col("x")).alias("w"))
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    found = scores.groupBy("dim").agg(*(F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs))
    errors = F.array(*(F.abs(F.col(f"c{i}_{j}") - (1.0 if i == j else 0.0)) for i, j in pairs))
    return found.select("dim", F.array_max(errors).alias("identity_error"))
