"""Whitened leading components of vectors; the eigenvectors come from contour integrals over eigenvalue intervals."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.arrow import map_batches
from tidemart.llm.store import written
from tidemart.llm.vectors import fits, largest, matrix, whole_numbers, widths

LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Contour:
    """``nodes`` quadrature points on the upper half of a circle, ``rounds`` filter steps at most per interval of about
    ``most`` eigenvalues. Eigenvalues nearer to each other than ``gap`` of the larger are not parted by an interval's
    end; those under ``zero`` of the largest count as zero."""

    nodes: int = 8
    rounds: int = 30
    most: int = 8
    gap: float = 1e-3
    zero: float = 1e-12
    seed: int = 11


CONTOUR = Contour()


def eigenvalues_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed a shift: the positive pivots of the symmetric factorisation of v - shift I (its inertia)."""
    a = v - shift * np.eye(len(v))
    positive = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        apart = np.abs(a)
        np.fill_diagonal(apart, 0)
        p, (q, r) = int(diagonal.argmax()), np.unravel_index(apart.argmax(), apart.shape)
        if max(diagonal[p], apart[q, r]) == 0:
            break
        # a pivot of one row while it is large enough, else of two rows, which has one eigenvalue of either sign
        block = [p] if diagonal[p] >= 0.64 * apart[q, r] else [q, r]
        pivot = a[np.ix_(block, block)]
        positive += 1 if len(block) == 2 else int(pivot[0, 0] > 0)
        rest = np.delete(np.arange(len(a)), block)
        side = a[np.ix_(rest, block)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
    return positive


def bracket(v: np.ndarray, rank: int, top: float) -> tuple[float, float]:
    """Bounds of the eigenvalue with this rank from above (1 the largest), by halving."""
    low, high = -1e-9 * top, top
    while high - low > 1e-7 * top:
        middle = (low + high) / 2
        low, high = (middle, high) if eigenvalues_above(v, middle) >= rank else (low, middle)
    return low, high


def intervals(v: np.ndarray, k: int, how: Contour) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) of intervals that hold the ``k`` largest eigenvalues, from above; ends lie in gaps."""
    top = float(np.abs(v).sum(axis=1).max())
    low, high = bracket(v, 1, top)
    high, out, seen = high + 0.05 * top, [], 0
    while seen < k:
        rank = min(k, seen + how.most)
        low = bracket(v, rank, top)[0]
        while rank < len(v):
            below = bracket(v, rank + 1, top)[1]
            if low - below > how.gap * abs(low):
                break
            rank, low = rank + 1, bracket(v, rank + 1, top)[0]
        else:
            below = low - 0.1 * abs(low) - 1e-6 * top
        end = (low + below) / 2
        out.append((end, high, rank - seen))
        seen, high = rank, end
    return out


def project(v: np.ndarray, low: float, high: float, count: int, how: Contour) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors inside an interval, by filtered subspace iteration.

    The filter is the contour integral of (zI - v)^-1 around the interval, by Gauss-Legendre quadrature; complex shifted
    systems are solved at its points. Rayleigh-Ritz then takes the eigenpairs out of the filtered subspace.
    """
    d, size = len(v), float(np.linalg.norm(v))
    angle, weight = np.polynomial.legendre.leggauss(how.nodes)
    turn = np.exp(1j * np.pi / 2 * (1 - angle))
    centre, radius = (low + high) / 2, (high - low) / 2
    y = np.random.default_rng(how.seed).standard_normal((d, min(d, 2 * count + 4)))
    best = None
    for _ in range(how.rounds):
        q = np.zeros_like(y)
        for t, w in zip(turn, weight):
            q += w / 2 * np.real(radius * t * np.linalg.solve((centre + radius * t) * np.eye(d) - v, y.astype(complex)))
        basis = np.linalg.qr(q)[0]
        e, u = np.linalg.eigh(basis.T @ v @ basis)
        y = basis @ u
        inside = (e > low) & (e < high)
        if inside.sum() != count:
            continue
        left = float(np.linalg.norm(v @ y[:, inside] - y[:, inside] * e[inside], axis=0).max())
        if best is not None and left >= best[0] / 2 and best[0] <= 1e-10 * size:  # rounding is all that is left
            break
        if best is None or left < best[0]:
            best = (left, e[inside], y[:, inside])
        if left <= 1e-16 * size:
            break
    if best is None or best[0] > 1e-10 * size:
        raise ArithmeticError(f"{count} eigenvalues between {low} and {high} were not found")
    return best[1], best[2]


def leading(v: np.ndarray, k: int, how: Contour = CONTOUR) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns; fewer, if fewer are not zero.

    The inertia of v - shift I at an interval's ends says how many eigenvalues it holds; as many have to be found.
    """
    top = float(np.abs(v).sum(axis=1).max()) if v.size else 0.0
    k = min(k, eigenvalues_above(v, how.zero * top)) if top > 0 else 0
    values, vectors = [np.zeros(0)], [np.zeros((len(v), 0))]
    for low, high, count in intervals(v, k, how) if k else []:
        if eigenvalues_above(v, low) - eigenvalues_above(v, high) != count:
            raise ArithmeticError(f"not {count} eigenvalues between {low} and {high}")
        e, u = project(v, low, high, count, how)
        values.append(e[::-1])
        vectors.append(u[:, ::-1])
    return np.concatenate(values)[:k], np.concatenate(vectors, axis=1)[:, :k]


def summed(parts: DataFrame) -> dict[tuple[int, int], object]:
    """Sums of ``value`` by ``i`` and ``j``, as many as a matrix of vector lengths has places."""
    return {(r.i, r.j): r.s for r in parts.groupBy("i", "j").agg(F.sum("value").alias("s")).collect()}


def sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number and exact sums of the vectors ``row.x``."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        total, n = [0] * width, 0
        for batch in batches:
            x = matrix(batch["row"].field("x"))
            n += len(x)
            own = x.sum(axis=0) if fits(largest(x) + 1, len(x) + 1) else x.astype(object).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, own)]
        if n:
            yield {"i": [0] * (width + 1), "j": list(range(width + 1)), "value": [Decimal(t) for t in [*total, n]]}

    found = summed(map_batches(vectors, "i int, j int, value decimal(38,0)", run))
    return int(found[0, width]), [int(found[0, j]) for j in range(width)]


def moments(vectors: DataFrame, centre: np.ndarray, turn: np.ndarray, n: int) -> np.ndarray:
    """Covariance of (x - centre) @ turn, divisor ``n``: a matrix per task, summed by place."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        total = None
        for batch in batches:
            y = (matrix(batch["row"].field("x")) - centre) @ turn
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.indices(total.shape)
            yield {"i": i.ravel(), "j": j.ravel(), "value": total.ravel()}

    size = turn.shape[1]
    out = np.zeros((size, size))
    for (i, j), value in summed(map_batches(vectors, "i int, j int, value double", run)).items():
        out[i, j] = value
    return out / n


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """sum((n * x - total)^2) of every row, exact; None beyond a long."""
    bound = n * (largest(x) + 1) + max(map(abs, total))
    if fits(bound, bound, len(total)):
        return ((n * x - np.array(total)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(c) - t) ** 2 for c, t in zip(row, total)) for row in x]
    return [e if e <= LONGEST else None for e in exact]


def whiten(vectors: DataFrame, k: int = 4, scale: int = 256, how: Contour = CONTOUR, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The first ``k`` whitened components of every vector, a row each.

    Vectors become whole numbers x = floor(scale * component). Covariances are over the distinct x, n in number with sums
    S, and centred before multiplying; components are unit eigenvectors numbered from 1 by falling eigenvalue e. Returns
    ``vec_id``, ``component``, ``n``, ``deviation`` (sum of (n*x-S)^2, exact; null beyond a long), ``whitened`` (x-S/n on the component,
    over sqrt(e)), ``explained`` (e over the sum of all eigenvalues) and ``identity_error`` (largest entry by size of the
    whitened covariance less the identity, measured over the distinct x).

    Null and empty vectors and those with null or non-finite components are left out. Vectors of each length are fitted
    by themselves, and have no more components than entries. A component of eigenvalue zero has a null ``whitened``;
    ``explained`` is null if all are zero, and ``identity_error`` looks at the other components (0 if there are none).
    Repeated rows are rows of their own, null ids stay null, an empty table gives an empty result, and other columns are
    not looked at. Of any table the driver holds one matrix of the vectors' length.
    """
    rows = whole_numbers(vectors, scale, embedding, key=vec_id)
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"`{vec_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = vectors.sparkSession.createDataFrame([], schema)
    for width in widths(rows):
        mine = rows.filter(F.col("width") == width)
        out = out.unionAll(whitened(mine, width, min(k, width), how).withColumnRenamed("key", vec_id))
    return out


def whitened(rows: DataFrame, width: int, k: int, how: Contour) -> DataFrame:
    """``whiten`` for the vectors of one length."""
    distinct = written(rows.select("x").distinct(), "fit-vectors").select(F.struct("x").alias("row"))
    n, total = sums(distinct, width)
    centre = np.array([s / n for s in total])
    v = moments(distinct, centre, np.eye(width), n)
    e, u = leading((v + v.T) / 2, k, how)
    turn = u / np.sqrt(e)
    error = float(np.abs(moments(distinct, centre, turn, n) - np.eye(len(e))).max(initial=0))
    trace = float(np.trace(v))
    explained = [float(x) / trace for x in e] + [0.0] * (k - len(e)) if trace > 0 else [None] * k

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            x = matrix(batch["row"].field("x"))
            values = np.full((len(x), k), np.nan)
            values[:, : len(e)] = (x - centre) @ turn
            flat = pa.array(values.ravel(), from_pandas=True)
            yield {
                "key": batch["row"].field("key"), "deviation": deviations(x, n, total),
                "w": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), flat),
            }

    slim = rows.select(F.struct("key", "x").alias("row"))
    made = map_batches(slim, f"key {rows.schema['key'].dataType.simpleString()}, deviation long, w array<double>", run)
    parts = F.array(*[F.lit(x).cast("double") for x in explained])
    each = made.select("key", "deviation", F.posexplode("w").alias("at", "whitened"))
    return each.select(
        "key", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(parts, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
