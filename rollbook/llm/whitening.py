"""Whitened embeddings by incremental eigendecomposition.

Every partition holds the spectrum of the scatter matrix of the vectors it has seen,
around their running mean, and takes one vector more by a rank-one update: with n
vectors before, the scatter grows by ``n / (n + 1)`` times the outer product of the
vector's distance to the mean. The new eigenvalues are the roots of the secular
equation ``1 + rho sum z_j^2 / (d_j - mu) = 0``, one between each two old ones, found
by safeguarded rational interpolation; components without weight and equal eigenvalues
are deflated first. Eigenvectors use the weights recomputed from the roots, so they
are orthogonal to working precision.

Two partitions' spectra are combined by one such update for each eigenpair of the
smaller one and one for the distance of the means, in rounds of ``FAN`` spectra a group.
The basis so found is refined once by Rayleigh-Ritz: the covariance of the vectors'
coordinates in it, centred exactly, is summed over all partitions and its
eigenvectors rotate the basis. Beyond numbers of one vector's length squared, nothing
is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.session import land

#: Units of the grid on which vectors are compared and fitted, and the components returned.
GRID, COMPONENTS = 256.0, 4
#: Spectra combined by one task.
FAN = 16

_EPS = np.finfo(float).eps
_SPECTRUM = "n long, high array<long>, low array<long>, mean array<double>, eigenvalues array<double>, basis array<double>"


class Spectrum(NamedTuple):
    """Vectors seen, their exact sums, mean, and the eigenvalues (rising) and eigenvectors of their scatter matrix."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray


def _empty(size: int) -> Spectrum:
    return Spectrum(0, [0] * size, np.zeros(size), np.zeros(size), np.eye(size))


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho sum z^2 / (d - mu)`` for strictly rising ``d``, and the matrix ``d_j - mu_i`` (row i).

    The root i lies between ``d_i`` and the next pole, the last within ``rho |z|^2`` of the last pole. Each is
    found as a distance from its nearer pole, so that differences to the poles keep full relative precision.
    """
    k = len(d)
    weight = rho * z * z
    upper = np.append(d[1:], d[-1] + weight.sum())
    width = upper - d
    middle = d + width / 2
    at_middle = 1 + (weight / (d - middle[:, None])).sum(axis=1)
    from_left = at_middle >= 0
    from_left[-1] = True
    origin = np.where(from_left, d, upper)
    poles = d - origin[:, None]
    next_pole = np.append(np.diagonal(poles, 1), 0.0)
    next_pole[-1] = upper[-1] - origin[-1]
    own_pole = np.diagonal(poles)
    low = np.where(from_left, 0.0, -width / 2)
    high = np.where(from_left, width / 2, 0.0)
    low[-1], high[-1] = (width[-1] / 2, width[-1]) if at_middle[-1] < 0 else (0.0, width[-1] / 2)
    at = (low + high) / 2
    left = np.tri(k)
    live = np.ones(k, bool)
    for _ in range(100):
        away = poles - at[:, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            terms = weight / away
            slopes = terms / away
            below, above = (terms * left).sum(axis=1), (terms * (1 - left)).sum(axis=1)
            value = 1 + below + above
            live &= (np.abs(value) > 4 * k * _EPS * (1 + np.abs(below) + np.abs(above))) & (high - low > 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
            if not live.any():
                break
            low, high = np.where(live & (value < 0), at, low), np.where(live & (value >= 0), at, high)
            slope_below, slope_above = (slopes * left).sum(axis=1), (slopes * (1 - left)).sum(axis=1)
            p, q = own_pole - at, next_pole - at
            c = value - p * slope_below - q * slope_above
            a = (p + q) * value - p * q * (slope_below + slope_above)
            b = p * q * value
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = at + step
        safe = np.isfinite(new) & (new > low) & (new < high)
        at = np.where(live, np.where(safe, new, (low + high) / 2), at)
    return origin + at, poles - at[:, None]


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors after adding ``rho vector vector^T``, ``rho > 0``."""
    z = vector @ basis
    length = float(np.sqrt(z @ z))
    if not length or not rho:
        return values, basis
    z, rho = z / length, rho * length * length
    small = 8 * _EPS * max(abs(values[-1]), abs(values[0]), rho)
    basis = basis.copy()
    # equal eigenvalues: turn their eigenvectors so that one of them has all the weight
    starts = np.flatnonzero(np.concatenate(([True], np.diff(values) > small)))
    for a, b in zip(starts, np.append(starts[1:], len(values))):
        part = z[a:b].copy()
        weight = np.sqrt(part @ part)
        if b - a == 1 or not weight:
            continue
        mirror = part.copy()
        mirror[-1] += np.copysign(weight, part[-1])
        mirror /= np.sqrt(mirror @ mirror)
        basis[:, a:b] -= 2 * np.outer(basis[:, a:b] @ mirror, mirror)
        z[a:b] = 0.0
        z[b - 1] = -np.copysign(weight, part[-1])
    active = np.flatnonzero(rho * np.abs(z) > small)
    if not len(active):
        return values, basis
    d = values[active]
    roots, away = secular_roots(d, z[active], rho)
    # weights for which these roots are exact, so that the eigenvectors come out orthogonal
    gaps = d[:, None] - d
    ratio = -away / np.where(gaps == 0, 1.0, gaps)
    weights = np.copysign(np.sqrt(np.abs(ratio.prod(axis=0)) / rho), z[active])
    turned = weights / away
    turned /= np.sqrt((turned * turned).sum(axis=1))[:, None]
    values = values.copy()
    values[active] = roots
    basis[:, active] = basis[:, active] @ turned.T
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


def add_vector(seen: Spectrum, x: np.ndarray, exact: list[int]) -> Spectrum:
    """The spectrum with one vector more."""
    away = x - seen.mean
    values, basis = rank_one(seen.values, seen.basis, away, seen.n / (seen.n + 1))
    return Spectrum(seen.n + 1, [a + b for a, b in zip(seen.sums, exact)], seen.mean + away / (seen.n + 1), values, basis)


def combine(one: Spectrum, other: Spectrum) -> Spectrum:
    """The spectrum of the vectors of both, by rank-one updates of the larger."""
    if one.n < other.n:
        one, other = other, one
    if not other.n:
        return one
    values, basis = one.values, one.basis
    for weight, direction in zip(other.values, other.basis.T):
        if weight > 0:
            values, basis = rank_one(values, basis, direction, float(weight))
    n = one.n + other.n
    away = other.mean - one.mean
    values, basis = rank_one(values, basis, away, one.n * other.n / n)
    return Spectrum(n, [a + b for a, b in zip(one.sums, other.sums)], one.mean + away * (other.n / n), values, basis)


def _row(s: Spectrum) -> dict:
    return {"n": s.n, "high": [v >> 32 for v in s.sums], "low": [v & 0xFFFFFFFF for v in s.sums], "mean": s.mean.tolist(), "eigenvalues": s.values.tolist(), "basis": s.basis.ravel().tolist()}


def _spectrum(row) -> Spectrum:
    mean = np.array(row["mean"], float)
    return Spectrum(int(row["n"]), [(int(h) << 32) + int(v) for h, v in zip(row["high"], row["low"])], mean, np.array(row["eigenvalues"], float), np.array(row["basis"], float).reshape(len(mean), -1))


_ARROW = pa.schema([("n", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("high", "low")), *((c, pa.list_(pa.float64())) for c in ("mean", "eigenvalues", "basis"))])


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _learn(size: int):
    """One spectrum a partition, by an update for each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _empty(size)
        for batch in batches:
            whole = _matrix(batch.column("x"), size)
            high, low = (whole >> 32).sum(axis=0).tolist(), (whole & 0xFFFFFFFF).sum(axis=0).tolist()
            nothing = [0] * size
            for x in whole.astype(float):
                seen = add_vector(seen, x, nothing)
            seen = seen._replace(sums=[s + (h << 32) + v for s, h, v in zip(seen.sums, high, low)])
        if seen.n:
            yield pa.RecordBatch.from_pylist([_row(seen)], schema=_ARROW)

    return run


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    spectra = [_spectrum(row) for row in group.sort_values(["n", "place"]).to_dict("records")]
    whole = spectra[0]
    for s in spectra[1:]:
        whole = combine(whole, s)
    return pd.DataFrame([{"place": int(group["place"].iloc[0]) // FAN, **_row(whole)}])


def learn_spectrum(fit: DataFrame, size: int) -> Spectrum:
    """The spectrum of the scatter matrix of all rows ``x`` (arrays of ``size`` longs), by partitions and rounds of merges."""
    spectra = land(fit.select("x").mapInArrow(_learn(size), _SPECTRUM).withColumn("place", F.monotonically_increasing_id()), "spectra")
    number = spectra.count()
    while number > 1:
        group = F.pmod(F.xxhash64("place"), F.lit(-(-number // FAN)))
        spectra = land(spectra.groupBy(group.alias("group")).applyInPandas(_merge, f"{_SPECTRUM}, place long"), "spectra")
        number = spectra.count()
    row = spectra.first()
    return _spectrum(row) if row else _empty(size)


def _centred(whole: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return whole.astype(float) - centre


def _summed(partials: DataFrame, length: int) -> np.ndarray:
    """Sums, over all partitions, of the places of their arrays ``part``."""
    rows = partials.select(F.posexplode("part").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(length)
    for r in rows:
        total[r["at"]] = r["v"]
    return total


def _products(size: int, centre: np.ndarray, directions: np.ndarray) -> object:
    """Per partition, sums of products (and of the coordinates themselves) of the centred vectors along ``directions``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = directions.shape[1]
        total = np.zeros(k * k + k)
        for batch in batches:
            along = _centred(_matrix(batch.column("x"), size), centre) @ directions
            total += np.concatenate(((along.T @ along).ravel(), along.sum(axis=0)))
        yield pa.RecordBatch.from_pylist([{"part": total.tolist()}], schema=pa.schema([("part", pa.list_(pa.float64()))]))

    return run


def covariance_along(fit: DataFrame, size: int, n: int, centre: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the coordinates of ``fit`` along ``directions``."""
    k = directions.shape[1]
    total = _summed(fit.select("x").mapInArrow(_products(size, centre, directions), "part array<double>"), k * k + k) / n
    return total[: k * k].reshape(k, k) - np.outer(total[k * k :], total[k * k :])


class Whitening(NamedTuple):
    """A fitted whitening: number of vectors, exact sums, components by falling eigenvalue, share of variance, error."""

    n: int
    sums: list[int]
    directions: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def on_grid(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """``id_column`` and ``x``, the vectors in whole units of the grid.

    A row goes if its vector is null or has an entry that is null, not finite, or too large for a long in
    units of the grid.
    """
    fits = F.forall(column, lambda e: F.coalesce(F.abs(e.cast("double")) * GRID < float(1 << 63), F.lit(False)))
    rows = vectors.where(F.col(column).isNotNull() & fits)
    return rows.select(F.col(id_column), F.transform(column, lambda e: F.floor(e.cast("double") * GRID)).alias("x"))


def fit_whitening(rows: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors ``x`` of ``rows``, all of length ``size``; None without a vector.

    Components without variance are left out, so fewer than ``components`` come back where the vectors have fewer
    dimensions or span less.
    """
    fit = land(rows.select("x").distinct(), "fit")
    learnt = learn_spectrum(fit, size)
    if not learnt.n:
        return None
    centre = np.array([s / learnt.n for s in learnt.sums])
    basis, _ = np.linalg.qr(learnt.basis)
    ritz, turn = np.linalg.eigh(covariance_along(fit, size, learnt.n, centre, basis))
    trace = ritz.sum()
    order = [i for i in np.argsort(-ritz, kind="stable")[:components] if ritz[i] > 8 * size * _EPS * trace]
    directions = basis @ turn[:, order]
    directions /= np.sqrt((directions * directions).sum(axis=0))
    largest = np.abs(directions).argmax(axis=0)
    directions *= np.sign(directions[largest, np.arange(len(order))])
    values = ritz[order]
    error = np.abs(covariance_along(fit, size, learnt.n, centre, directions / np.sqrt(values)) - np.eye(len(order))).max(initial=0.0) if order else 0.0
    return Whitening(learnt.n, learnt.sums, directions, values, values / trace if trace else values, float(error))


def _deviations(whole: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Exact sums over dimensions of ``(n x - S)^2``; null where that is no long."""
    most = n * max(int(np.abs(whole).max(initial=0)), 1) + max(map(abs, sums), default=0)
    if most * most * max(len(sums), 1) < 1 << 63:
        away = n * whole - np.array(sums, np.int64)
        return pa.array((away * away).sum(axis=1))
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in whole.tolist()]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def _apply(fitted: Whitening, size: int, names: list[str]):
    centre = np.array([s / fitted.n for s in fitted.sums])
    scaled = fitted.directions / np.sqrt(fitted.eigenvalues)
    k = scaled.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _matrix(batch.column("x"), size)
            along = _centred(whole, centre) @ scaled
            row = pa.array(np.repeat(np.arange(batch.num_rows), k))
            tiled = (np.tile(v, batch.num_rows) for v in (np.arange(1, k + 1, dtype=np.int32), np.full(k, fitted.n), fitted.explained, np.full(k, fitted.identity_error)))
            component, n, explained, error = map(pa.array, tiled)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), component, n, _deviations(whole, fitted.n, fitted.sums).take(row), pa.array(along.ravel()), explained, error], names=names)

    return run


def whitened(vectors: DataFrame, id_column: str, column: str, components: int = COMPONENTS) -> DataFrame:
    """The vectors' whitened coordinates, one row for each vector and component.

    ``vectors`` needs ``id_column`` and ``column`` (array of numbers); other columns are ignored. Returns the id,
    ``component`` (int, from 1 by falling eigenvalue), ``n`` (distinct vectors fitted), ``deviation`` (exact sum of
    ``(n x - S)^2``; null if it is no long), ``whitened``, ``explained`` and ``identity_error``. Rows go as in
    ``on_grid``, and those whose length is not the most frequent one (of equally frequent ones the greater).
    Repeated rows and null ids are returned as they come and fitted once by vector. Components without variance do not
    exist: one distinct vector, empty vectors or an empty table give no rows. The function starts jobs.
    """
    rows = on_grid(vectors, id_column, column)
    id_type = rows.schema[id_column].dataType.simpleString()
    names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = f"`{id_column}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = lengths["size"] if lengths else 0
    rows = rows.where(F.size("x") == size)
    fitted = fit_whitening(rows, size, components) if size else None
    if not fitted or not len(fitted.eigenvalues):
        return vectors.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(_apply(fitted, size, names), schema)
