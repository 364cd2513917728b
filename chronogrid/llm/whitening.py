"""Whitening of vectors by an incremental eigendecomposition, refined over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronogrid.llm.kernels import prepare
from chronogrid.session import materialise

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000  # a component c is worked with as floor(SCALE * c) + SHIFT
LARGEST = float(1 << 53)  # scaled components from here on count as not finite
FAN_IN = 16  # partial results that one task merges
ROUNDING = 1e-13  # eigenvalues below this share of the largest are rounding, not variance
EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z^2 / (d - x) for rising d, as distances `d[j] - root[i]` and roots.

    Root i lies between d[i] and d[i + 1] (the last below d[-1] + |z|^2). Each is held as a
    distance from the nearer pole, so that small gaps keep their digits, and found by a
    rational interpolation through both poles that falls back to halving its bracket.
    """
    k, z2 = len(d), z * z
    gap = np.append(d[1:], d[-1] + z2.sum()) - d
    middle = 1 + (z2 / ((d - d[:, None]) - gap[:, None] / 2)).sum(axis=1)
    right = middle < 0
    right[-1] = False
    origin = np.arange(k) + right
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, gap / 2)
    if middle[-1] < 0:
        low[-1], high[-1] = gap[-1] / 2, gap[-1]
    base = d - d[origin][:, None]
    other = np.append(base[np.arange(k - 1), np.arange(1, k)], gap[-1])
    at = np.arange(k)
    below = at <= at[:, None]
    mu = (low + high) / 2
    for _ in range(120):
        delta = base - mu[:, None]
        delta[delta == 0] = TINY
        q = z2 / delta
        f = 1 + q.sum(axis=1)
        found = np.abs(f) <= EPS * k * (1 + np.abs(q).sum(axis=1))
        if found.all():
            break
        low, high = np.where(f < 0, mu, low), np.where(f < 0, high, mu)
        slope = q / delta
        psi = np.where(below, slope, 0).sum(axis=1)
        phi = slope.sum(axis=1) - psi
        d1, d2 = delta[at, at], other - mu
        a = (d1 + d2) * f - d1 * d2 * (psi + phi)
        b = d1 * d2 * f
        c = f - d1 * psi - d2 * phi
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            new = mu + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        inside = (new > low) & (new < high)
        new = np.where(found, mu, np.where(inside, new, (low + high) / 2))
        if (new == mu).all():
            break
        mu = new
    return delta, d[origin] + mu


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of a matrix after `weight` times the
    outer product of `vector` is added.

    Directions that the vector does not touch, and all but one of equal eigenvalues (after
    a rotation), are deflated: they stay as they are. The rest solve the secular equation;
    the vector is then recomputed from the roots, which keeps eigenvectors orthogonal.
    """
    z = (basis.T @ vector) * np.sqrt(weight)
    norm = np.sqrt(z @ z)
    if not norm > 0:
        return values, basis
    values, basis = values.copy(), basis.copy()
    tolerance = 8 * EPS * max(np.abs(values).max(), norm * norm)
    z[np.abs(z) * norm <= tolerance] = 0
    live = np.flatnonzero(z)
    ahead = (values[live[1:]] - values[live[:-1]]) * np.abs(z[live[1:]] * z[live[:-1]])
    close = (ahead <= tolerance * (z[live[1:]] ** 2 + z[live[:-1]] ** 2)).any()
    for i, j in zip(live[:-1], live[1:], strict=True) if close else ():
        length = np.hypot(z[i], z[j])
        c, s = z[j] / length, z[i] / length
        if (values[j] - values[i]) * abs(c * s) <= tolerance:
            z[i], z[j] = 0.0, length
            basis[:, [i, j]] = np.stack([c * basis[:, i] - s * basis[:, j], s * basis[:, i] + c * basis[:, j]], axis=1)
            values[i], values[j] = c * c * values[i] + s * s * values[j], s * s * values[i] + c * c * values[j]
    live = np.flatnonzero(z)
    if len(live) == 1:
        values[live] += z[live] ** 2
    elif len(live):
        d, part = values[live], z[live]
        delta, roots = secular_roots(d, part)
        apart = d[:, None] - d
        np.fill_diagonal(apart, 1.0)
        exact = np.sqrt(np.abs(np.prod(-delta / apart, axis=0))) * np.sign(part)
        turn = exact / delta
        turn /= np.linalg.norm(turn, axis=1, keepdims=True)
        values[live], basis[:, live] = roots, basis[:, live] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


class Spectrum:
    """Number, exact sums and the scatter matrix's eigenpairs of vectors of one length."""

    def __init__(self, dim: int):
        self.n, self.sums = 0, np.zeros(dim, np.int64)  # of the vectors less SHIFT
        self.values, self.basis = np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        """Vectors (rows) one by one, equal ones of a batch together."""
        rows, copies = np.unique(x - SHIFT, axis=0, return_counts=True)
        for row, times in zip(rows, copies.tolist(), strict=True):
            if self.n:
                share = self.n * times / (self.n + times)
                self.values, self.basis = rank_one(self.values, self.basis, row - self.sums / self.n, share)
            self.n += times
            self.sums = self.sums + times * row

    def merge(self, other: Spectrum) -> None:
        """The other's eigenpairs and then the distance of the means, each of rank one."""
        if self.n and other.n:
            apart = other.sums / other.n - self.sums / self.n
            for value, vector in zip(other.values, other.basis.T, strict=True):
                if value > EPS * other.values[-1]:
                    self.values, self.basis = rank_one(self.values, self.basis, vector, value)
            share = self.n * other.n / (self.n + other.n)
            self.values, self.basis = rank_one(self.values, self.basis, apart, share)
        elif other.n:
            self.values, self.basis = other.values, other.basis
        self.n += other.n
        self.sums = self.sums + other.sums

    def row(self) -> dict:
        return {"n": self.n, "sums": self.sums, "values": self.values, "basis": self.basis.ravel()}

    @classmethod
    def of_row(cls, row: dict) -> Spectrum:
        out = cls(len(row["sums"]))
        out.n, out.sums = row["n"], np.array(row["sums"], np.int64)
        out.values = np.array(row["values"])
        out.basis = np.array(row["basis"]).reshape(len(out.sums), -1)
        return out


def whole_numbers(vector_col: str) -> Column:
    """The vector as scaled whole numbers; NULL if a component is NULL or not finite, or if
    there are none."""
    wide = F.transform(vector_col, lambda c: c.cast("double") * F.lit(float(SCALE)))
    bad = F.exists(wide, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    good = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & ~bad
    return F.when(good, F.transform(wide, lambda c: F.floor(c).cast("long") + SHIFT))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, vectors) of a batch with a column `x`."""
    lists = batch.column("x")
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    begin = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield int(dim), at, flat[begin[at][:, None] + np.arange(dim)]


def partials(rows: DataFrame, schema: str, start: Callable, add: Callable, done: Callable, label: str) -> DataFrame:
    """One row per partition and vector length, written so that merging them needs no data.

    A partition's state for a length is `start(dim)`; `add(state, vectors)` returns the next
    one and `done(state)` its columns.
    """
    fields = StructType.fromDDL(f"dim int, slot long, {schema}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, object] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                states[dim] = add(states[dim] if dim in states else start(dim), x)
        slot = TaskContext.get().partitionId()
        for dim, state in states.items():
            yield _one_row({"dim": dim, "slot": slot} | done(state))

    return materialise(rows.mapInArrow(run, fields), label)


def _one_row(values: dict) -> pa.RecordBatch:
    kinds = {"dim": pa.int32(), "slot": pa.int64(), "n": pa.int64()}
    lists = {"sums": pa.list_(pa.int64())}
    arrays = [pa.array([v], kinds.get(k) or lists.get(k) or pa.list_(pa.float64())) for k, v in values.items()]
    return pa.RecordBatch.from_arrays(arrays, list(values))


def merged(states: DataFrame, merge: Callable[[list[dict]], dict]) -> dict[int, dict]:
    """The states of each length merged FAN_IN at a time, in a tree of Spark groups."""
    width = (states.agg(F.max("slot")).first()[0] or 0) + 1
    schema = states.schema

    def group(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["slot"])
        key = {"dim": rows[0]["dim"], "slot": rows[0]["slot"] // FAN_IN}
        return pa.Table.from_batches([_one_row(key | merge(rows))])

    while True:
        states = states.groupBy("dim", F.floor(F.col("slot") / FAN_IN)).applyInArrow(group, schema)
        width = -(-width // FAN_IN)
        if width == 1:
            return {r["dim"]: r.asDict() for r in states.collect()}  # one row per vector length


def _merge_spectra(rows: list[dict]) -> dict:
    first = Spectrum.of_row(rows[0])
    for row in rows[1:]:
        first.merge(Spectrum.of_row(row))
    return first.row()


def _add_up(rows: list[dict]) -> dict:
    return {"total": np.sum([r["total"] for r in rows], axis=0)}


def products(rows: DataFrame, bases: dict[int, tuple[np.ndarray, np.ndarray]], label: str) -> dict[int, np.ndarray]:
    """Sums over all rows of the outer products of (x - centre) @ basis, by vector length."""
    shared = rows.sparkSession.sparkContext.broadcast(bases)

    def add(state: np.ndarray | None, x: np.ndarray) -> np.ndarray:
        centre, basis = shared.value[x.shape[1]]
        y = (x - SHIFT - centre) @ basis
        return y.T @ y if state is None else state + y.T @ y

    sums = partials(rows, "total array<double>", lambda dim: None, add, lambda s: {"total": s.ravel()}, label)
    found = merged(sums, _add_up)
    return {dim: np.array(r["total"]).reshape(bases[dim][1].shape[1], -1) for dim, r in found.items()}


def _add_vectors(state: Spectrum, x: np.ndarray) -> Spectrum:
    state.add(x)
    return state


def exact_deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over components of (n x - S)^2, exactly; None where it does not fit a long."""
    x = x - SHIFT
    reach = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if x.shape[1] * reach * reach < 1 << 63:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    wide = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return [v if v < 1 << 63 else None for v in wide]


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Whitened principal components of all vectors, one row per vector and component.

    Returns (id_col, component, n, deviation, whitened, explained, identity_error):
    components are numbered from 1 by falling eigenvalue of the covariance of all vectors
    (as whole numbers floor(64 c) + 1000000), `whitened` is the centred vector along the
    component over the root of its eigenvalue, `explained` the eigenvalue's share of the
    trace, `deviation` the exact squared distance from the mean times n^2, and
    `identity_error` how far the covariance of the result is from the identity.

    Partitions add their vectors one by one to an eigendecomposition by centred updates of
    rank one; partitions' spectra are merged by updates of rank one too, FAN_IN at a time
    in a tree of Spark groups. A pass over all vectors then projects the covariance on
    that basis, and the eigenvectors of this small matrix turn it (Rayleigh-Ritz). A state
    is as large as the square of the vectors' length and does not grow with the rows.

    Vectors that are NULL, empty or hold a NULL, NaN, infinite or astronomically large
    component (over 2^47) are left out. Vectors of different lengths are fitted apart.
    Components without variance, as with equal vectors or fewer vectors than components,
    are left out: a single vector gives no row. Repeated rows count each; NULL ids stay;
    `deviation` is NULL where it exceeds a long; other columns are ignored whatever their
    names; an empty table gives no rows.
    """
    spark = prepare(vectors.sparkSession)
    whole = vectors.select(F.col(id_col).alias("id"), whole_numbers(vector_col).alias("x")).where("x IS NOT NULL")
    rows = whole.select("x")
    schema = "n long, sums array<long>, values array<double>, basis array<double>"
    spectra = partials(rows, schema, Spectrum, _add_vectors, Spectrum.row, "spectra")
    found = {dim: Spectrum.of_row(r) for dim, r in merged(spectra, _merge_spectra).items()}
    bases = {dim: (s.sums / s.n, np.linalg.qr(s.basis)[0]) for dim, s in found.items()}
    models = {}
    for dim, square in products(rows, bases, "projected").items() if bases else ():
        values, turn = np.linalg.eigh((square + square.T) / (2 * found[dim].n))
        values, turn = values[::-1], turn[:, ::-1]
        kept = int((values > ROUNDING * max(values[0], 0)).sum())
        kept = min(components, kept) if values[0] > 0 else 0
        centre, basis = bases[dim]
        scaled = (basis @ turn)[:, :kept] / np.sqrt(values[:kept])
        models[dim] = (found[dim].n, found[dim].sums, centre, scaled, values[:kept] / values.sum() if kept else values[:0])
    models = {dim: m for dim, m in models.items() if m[3].shape[1]}
    errors = {}
    if models:
        made = rows.where(F.size("x").isin(*models))
        for dim, square in products(made, {d: m[2:4] for d, m in models.items()}, "whitened").items():
            errors[dim] = float(np.abs(square / models[dim][0] - np.eye(len(square))).max())
    shared = spark.sparkContext.broadcast((models, errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, off = shared.value
        for batch in batches:
            for dim, at, x in _by_length(batch):
                if dim not in fits:
                    continue
                n, sums, centre, basis, explained = fits[dim]
                count, k = len(at), basis.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(np.repeat(at, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, n)),
                        pa.array([v for v in exact_deviation(x, n, sums) for _ in range(k)], pa.int64()),
                        pa.array(((x - SHIFT - centre) @ basis).ravel()),
                        pa.array(np.tile(explained, count)),
                        pa.array(np.full(count * k, off[dim])),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = whole.schema["id"].dataType.simpleString()
    out = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return whole.mapInArrow(run, out).withColumnRenamed("id", id_col)
