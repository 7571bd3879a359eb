"""Additive smooth models from one pass over the data.

Every term is a basis (an array of Column expressions) and penalties on its
wiggliness.  Executors sum the cross products of all columns once; that matrix
(its size depends on the columns only) is all the driver sees.  From it come
the fits of every subset of terms and every penalty, their effective degrees
of freedom, generalised cross-validation and Akaike's criterion.

Rows that lack the target or a covariate take no part in a fit and get no
prediction.  Without a single whole row there is nothing to fit: ``ValueError``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
from py4j.protocol import Py4JError
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.functions import basis

#: Smoothing parameters that are tried, as powers of ten of the data's own scale.
POWERS = np.arange(-6.0, 8.5, 0.5)
NOTHING = "no row has the target and all covariates"


# --- terms ------------------------------------------------------------------

@dataclass(frozen=True)
class Line:
    """Straight effect of a column."""

    x: str

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.x,)

    @property
    def name(self) -> str:
        return self.x

    size = 1
    centred = False

    def places(self) -> list[Column]:
        return [F.col(self.x).cast("double")]

    def column(self, x: Column) -> Column:
        return F.array(x)

    def penalties(self) -> list[np.ndarray]:
        return []

    def shape(self) -> np.ndarray:
        return np.eye(1)


@dataclass(frozen=True)
class Spline:
    """Cubic spline of a column between its least and largest value."""

    x: str
    size: int = 10
    low: float | None = None
    high: float | None = None
    centred = True

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.x,)

    @property
    def name(self) -> str:
        return f"s({self.x})"

    def places(self) -> list[Column]:
        return list(basis.on_steps(F.col(self.x).cast("double"), self.low, self.high, self.size))

    def column(self, inside: Column, beyond: Column) -> Column:
        return basis.spline(inside, beyond, self.size)

    def penalties(self) -> list[np.ndarray]:
        return [_bending(self.size, self.size - 3, lambda j: [j - 1])]

    def shape(self) -> np.ndarray:
        return np.eye(self.size)


@dataclass(frozen=True)
class Cyclic:
    """Cubic spline on a ring, as for the hour of the day."""

    x: str
    period: float
    size: int = 8
    low: float = 0.0
    centred = True

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.x,)

    @property
    def name(self) -> str:
        return f"cc({self.x})"

    def places(self) -> list[Column]:
        return [basis.on_ring(F.col(self.x).cast("double"), self.low, self.period, self.size)]

    def column(self, u: Column) -> Column:
        return basis.ring(u, self.size)

    def penalties(self) -> list[np.ndarray]:
        return [_bending(self.size, self.size, lambda j: [j - self.size, j, j + self.size])]

    def shape(self) -> np.ndarray:
        return np.eye(self.size)


@dataclass(frozen=True)
class Surface:
    """Thin-plate surface over two columns of one unit; turning the axes changes nothing."""

    x: str
    y: str
    knots: int | tuple[tuple[float, float], ...] = 12
    centre: tuple[float, float] = (0.0, 0.0)
    scale: float = 1.0
    centred = True

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.x, self.y)

    @property
    def name(self) -> str:
        return f"s({self.x},{self.y})"

    @property
    def size(self) -> int:
        return len(self.knots) + 2

    def places(self) -> list[Column]:
        return [(F.col(c).cast("double") - m) / self.scale for c, m in zip(self.inputs, self.centre)]

    def column(self, x: Column, y: Column) -> Column:
        return basis.radial([x, y], self.knots)

    def penalties(self) -> list[np.ndarray]:
        k = np.array(self.knots)
        r2 = ((k[:, None, :] - k[None, :, :]) ** 2).sum(axis=2)
        plates = np.where(r2 > 0, r2 * np.log(np.where(r2 > 0, r2, 1.0)) / 2, 0.0)
        full = np.zeros((self.size, self.size))
        full[: len(k), : len(k)] = plates
        z = self.shape()
        return [z.T @ full @ z]

    def shape(self) -> np.ndarray:
        """Plates orthogonal to straight effects over the knots; the straight effects stay."""
        k = np.array(self.knots)
        q, _ = np.linalg.qr(np.hstack([np.ones((len(k), 1)), k]), mode="complete")
        free = q[:, 3:]
        out = np.zeros((self.size, free.shape[1] + 2))
        out[: len(k), : free.shape[1]] = free
        out[len(k) :, free.shape[1] :] = np.eye(2)
        return out


@dataclass(frozen=True)
class Product:
    """Tensor product of two or more terms, one penalty for each."""

    margins: tuple
    centred = True

    @property
    def inputs(self) -> tuple[str, ...]:
        return tuple(c for m in self.margins for c in m.inputs)

    @property
    def name(self) -> str:
        return f"te({','.join(self.inputs)})"

    @property
    def size(self) -> int:
        return math.prod(m.size for m in self.margins)

    def penalties(self) -> list[np.ndarray]:
        out = []
        for i, margin in enumerate(self.margins):
            for s in margin.penalties():
                parts = [s if i == j else np.eye(m.size) for j, m in enumerate(self.margins)]
                whole = parts[0]
                for part in parts[1:]:
                    whole = np.kron(whole, part)
                out.append(whole)
        return out

    def shape(self) -> np.ndarray:
        return np.eye(self.size)


Term = Line | Spline | Cyclic | Surface | Product


def _bending(size: int, steps: int, places) -> np.ndarray:
    """Integral of the product of second derivatives; exact, as they are straight on every step."""
    nodes = (np.arange(steps)[:, None] + 0.5 + np.array([-1, 1]) / (2 * math.sqrt(3))).ravel()

    def bend(t: np.ndarray) -> np.ndarray:
        s = np.abs(t)
        return np.where(s < 1, 3 * s - 2, np.where(s < 2, 2 - s, 0.0))

    second = np.stack([sum(bend(nodes - c) for c in places(j)) for j in range(size)])
    return second @ second.T / 2


def farthest(df: DataFrame, x: str, y: str, n: int) -> tuple[tuple[tuple[float, float], ...], tuple[float, float], float]:
    """``n`` knots far from each other, the centre and the spread; a knot is one pass and one row back.

    The first is the farthest from the centre, so turning the axes turns the knots.
    """
    points = df.select(F.col(x).cast("double").alias("a"), F.col(y).cast("double").alias("b")).dropna().persist()
    try:
        a, b, va, vb, count = points.agg(F.avg("a"), F.avg("b"), F.var_pop("a"), F.var_pop("b"), F.count_distinct("a", "b")).first()
        if not count:
            raise ValueError(f"no row has both {x} and {y}")
        scale = math.sqrt(va + vb) or 1.0
        known, chosen = [(a, b)], []
        while len(chosen) < min(n, count):
            gaps = [F.pow(F.col("a") - p, 2) + F.pow(F.col("b") - q, 2) for p, q in known]
            gap = F.least(*gaps) if len(gaps) > 1 else gaps[0]
            chosen.append(tuple(points.agg(F.max_by(F.struct("a", "b"), F.struct(gap, "a", "b"))).first()[0]))
            known = list(chosen)
    finally:
        points.unpersist()
    if len(chosen) < 4:
        raise ValueError("a surface needs four different points")
    return tuple(((p - a) / scale, (q - b) / scale) for p, q in chosen), (a, b), scale


def prepare(terms: Iterable[Term], df: DataFrame) -> list[Term]:
    """Terms with their ranges and knots taken from all rows; ranges of all splines come from one pass."""
    terms = list(terms)
    open_ = {m.x for t in terms for m in (t.margins if isinstance(t, Product) else (t,)) if isinstance(m, Spline) and m.low is None}
    ranges: dict[str, tuple[float, float]] = {}
    if open_:
        names = sorted(open_)
        row = df.agg(*[f(F.col(c).cast("double")) for c in names for f in (F.min, F.max)]).first()
        ranges = {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(names)}
        lacking = [c for c, (low, _) in ranges.items() if low is None]
        if lacking:
            raise ValueError(f"no values of {lacking}")

    def ready(t: Term) -> Term:
        if isinstance(t, Product):
            return replace(t, margins=tuple(ready(m) for m in t.margins))
        if isinstance(t, Spline) and t.low is None:
            return replace(t, low=ranges[t.x][0], high=ranges[t.x][1])
        if isinstance(t, Surface) and isinstance(t.knots, int):
            knots, centre, scale = farthest(df, t.x, t.y, t.knots)
            return replace(t, knots=knots, centre=centre, scale=scale)
        return t

    return [ready(t) for t in terms]


def with_basis(df: DataFrame, terms: Sequence[Term]) -> DataFrame:
    """The frame with an array column ``__b<i>`` for each prepared term.

    Places, bases and products are columns of their own, one upon the other, so
    that each is computed once and the generated code stays small.
    """
    plain = {(i, j): m for i, t in enumerate(terms) for j, m in enumerate(t.margins if isinstance(t, Product) else (t,))}
    names = {(i, j): f"__b{i}_{j}" if isinstance(terms[i], Product) else f"__b{i}" for i, j in plain}
    places = {(i, j): {f"__u{i}_{j}_{n}": c for n, c in enumerate(m.places())} for (i, j), m in plain.items()}
    df = df.withColumns({name: c for found in places.values() for name, c in found.items()})
    df = df.withColumns({names[at]: m.column(*map(F.col, places[at])) for at, m in plain.items()})
    for i, t in enumerate(terms):
        if isinstance(t, Product):
            held, size = names[i, 0], t.margins[0].size
            for j, m in enumerate(t.margins[1:], 1):
                name = f"__b{i}" if j == len(t.margins) - 1 else f"__b{i}_p{j}"
                df = df.withColumn(name, basis.products(held, size, names[i, j], m.size))
                held, size = name, size * m.size
    return df


# --- cross products ---------------------------------------------------------

@dataclass(frozen=True)
class Gram:
    """Weighted cross products of one, all basis columns and the target."""

    terms: tuple[Term, ...]
    n: float
    xx: np.ndarray  # with the intercept first
    xy: np.ndarray
    yy: float

    def columns(self, names: Sequence[str] | None = None) -> list[tuple[Term, slice]]:
        out, at = [], 1
        for t in self.terms:
            if names is None or t.name in names:
                out.append((t, slice(at, at + t.size)))
            at += t.size
        return out


def cross_products(df: DataFrame, arrays: Mapping[str, int], *values: Column, weight: Column | None = None) -> np.ndarray:
    """Sums of the products of 1, all entries of the arrays (with their sizes), and the values, over rows that lack none of them."""
    row = F.concat(F.array(F.lit(1.0)), *arrays, F.array(*[v.cast("double") for v in values]))
    if weight is not None:
        row = F.transform(row, lambda x: x * F.sqrt(weight))
    whole = df.select(row.alias("row")).where(~F.exists("row", lambda x: x.isNull() | F.isnan(x)))
    vectors = MLUtils.convertVectorColumnsFromML(whole.select(array_to_vector("row").alias("row")), "row")
    matrix = RowMatrix(vectors, numCols=1 + sum(arrays.values()) + len(values))
    try:
        found = matrix.computeGramianMatrix().toArray()
    except Py4JError:
        if whole.isEmpty():  # a table without partitions
            raise ValueError(NOTHING) from None
        raise
    if not found[0, 0]:
        raise ValueError(NOTHING)
    return found


def _arrays(terms: Sequence[Term]) -> dict[str, int]:
    return {f"__b{i}": t.size for i, t in enumerate(terms)}


def gram(df: DataFrame, terms: Sequence[Term], target: str, weight: str | None = None) -> Gram:
    """One pass for all terms; see ``prepare``."""
    held = with_basis(df, terms)
    whole = cross_products(held, _arrays(terms), F.col(target), weight=None if weight is None else F.col(weight))
    return Gram(tuple(terms), float(whole[0, 0]), whole[:-1, :-1], whole[:-1, -1], float(whole[-1, -1]))


def binned_gram(df: DataFrame, terms: Sequence[Term], target: str, bins: Mapping[str, int]) -> Gram:
    """Cross products of covariates moved to the middles of ``bins`` equal steps of their range.

    Rows become weighted cells before anything is shuffled, so what moves is at
    most one row per cell and task.  Covariates without bins keep their values
    (an hour or a month has few).  A covariate moves by half a step at most.
    """
    inputs = sorted({c for t in terms for c in t.inputs})
    whole = df.select(*[F.col(c).cast("double").alias(c) for c in inputs], F.col(target).cast("double").alias("__y")).dropna()
    row = whole.agg(*[f(c) for c in sorted(bins) for f in (F.min, F.max)]).first()
    middles = {}
    for i, c in enumerate(sorted(bins)):
        low, high = row[2 * i], row[2 * i + 1]
        if low is None:
            raise ValueError(NOTHING)
        step = (high - low) / bins[c] or 1.0
        middles[c] = low + (F.least(F.floor((F.col(c) - low) / step), F.lit(bins[c] - 1)) + 0.5) * step
    cells = whole.withColumns(middles).groupBy(*inputs).agg(
        F.count(F.lit(1)).alias("__n"), F.avg("__y").alias(target), F.sum(F.col("__y") * F.col("__y")).alias("__yy"))
    cells = cells.persist()
    try:
        found = gram(cells, terms, target, "__n")
        return replace(found, yy=cells.agg(F.sum("__yy")).first()[0])
    finally:
        cells.unpersist()


# --- fits -------------------------------------------------------------------

@dataclass(frozen=True)
class Fit:
    """Coefficients of the basis columns and how the fit stands."""

    terms: tuple[Term, ...]
    intercept: float
    coefficients: tuple[np.ndarray, ...]
    smoothing: tuple[float, ...]
    n: float
    rss: float
    edf: float
    link: str = "identity"
    deviance: float | None = None

    @property
    def gcv(self) -> float:
        return self.n * self.rss / max(self.n - self.edf, 1e-9) ** 2

    @property
    def aic(self) -> float:
        """Akaike's criterion of a Gaussian fit, effective degrees of freedom in the place of columns."""
        return self.n * (math.log(2 * math.pi * self.rss / self.n) + 1) + 2 + 2 * self.edf

    def predict(self, df: DataFrame, into: str) -> DataFrame:
        held = with_basis(df, self.terms)
        at = F.lit(float(self.intercept))
        for i, c in enumerate(self.coefficients):
            at = at + _dot(f"__b{i}", c)
        return held.select(*[F.col(f"`{c}`") for c in df.columns if c != into], (F.exp(at) if self.link == "log" else at).alias(into))

    def effect(self, df: DataFrame, name: str, into: str) -> DataFrame:
        """The frame with the part of one term."""
        i = [t.name for t in self.terms].index(name)
        return with_basis(df, self.terms).select(*[F.col(f"`{c}`") for c in df.columns], _dot(f"__b{i}", self.coefficients[i]).alias(into))


def _dot(array: str, weights: np.ndarray) -> Column:
    return sum((F.get(array, F.lit(k)) * float(w) for k, w in enumerate(weights)), F.lit(0.0))


@dataclass
class _System:
    """Normal equations of a choice of terms: columns turned so that every smooth term sums to zero."""

    a: np.ndarray
    b: np.ndarray
    turn: np.ndarray
    penalties: list[np.ndarray] = field(default_factory=list)
    blocks: list[slice] = field(default_factory=list)


def _null_space(row: np.ndarray) -> np.ndarray:
    q, _ = np.linalg.qr(row[:, None], mode="complete")
    return q[:, 1:]


def _system(g: Gram, chosen: list[tuple[Term, slice]], drop: bool) -> _System:
    size = len(g.xy)
    turns, sizes = [], []
    for t, at in chosen:
        z = t.shape()
        if t.centred:
            z = z @ _null_space(g.xx[0, at] @ z)
        turns.append(z)
        sizes.append(z.shape[1])
    turn = np.zeros((size, 1 + sum(sizes)))
    turn[0, 0] = 1.0
    out = _System(np.empty(0), np.empty(0), turn)
    place = 1
    for (t, at), z in zip(chosen, turns):
        block = slice(place, place + z.shape[1])
        turn[at, block] = z
        out.blocks.append(block)
        place = block.stop
    out.a, out.b = turn.T @ g.xx @ turn, turn.T @ g.xy
    for (t, at), z, block in zip(chosen, turns, out.blocks):
        inner = np.linalg.lstsq(t.shape(), z, rcond=None)[0]  # z in the coordinates of the term's own shape
        own = [inner.T @ s @ inner for s in t.penalties()]
        if drop:  # what no penalty bends is shrunk by one more
            total = sum((s / np.trace(s) for s in own), np.zeros((z.shape[1],) * 2))
            values, vectors = np.linalg.eigh(total)
            straight = vectors[:, values < 1e-8 * max(values.max(initial=0.0), 1e-300)] if own else np.eye(z.shape[1])
            if straight.shape[1]:
                own.append(straight @ straight.T)
        scale = np.trace(out.a[block, block])
        for s in own:
            whole = np.zeros_like(out.a)
            whole[block, block] = s * (scale / (np.trace(s) or 1.0))
            out.penalties.append(whole)
    return out


def _inverse(m: np.ndarray) -> np.ndarray:
    """Inverse of a symmetric matrix; directions the data do not tell apart stay at zero."""
    d = 1 / np.sqrt(np.where(np.diag(m) > 0, np.diag(m), 1.0))
    values, vectors = np.linalg.eigh(m * d[:, None] * d[None, :])
    keep = values > 1e-12 * values.max()
    return ((vectors[:, keep] / values[keep]) @ vectors[:, keep].T) * d[:, None] * d[None, :]


def _solve(s: _System, smoothing: Sequence[float], yy: float) -> tuple[np.ndarray, float, float]:
    """Coefficients, residual sum of squares, effective degrees of freedom."""
    inverse = _inverse(s.a + sum((w * p for w, p in zip(smoothing, s.penalties)), np.zeros_like(s.a)))
    beta = inverse @ s.b
    rss = max(yy - 2 * beta @ s.b + beta @ s.a @ beta, 0.0)
    return beta, float(rss), float(np.trace(inverse @ s.a))


def _choose(s: _System, n: float, yy: float, gamma: float) -> tuple[float, ...]:
    """Smoothing parameters of least generalised cross-validation, one after the other until none changes."""

    def worth(powers: np.ndarray) -> float:
        _, rss, edf = _solve(s, 10.0**powers, yy)
        return n * rss / max(n - gamma * edf, 1e-9) ** 2

    powers = np.zeros(len(s.penalties))
    best = worth(powers)
    for _ in range(20):
        before = powers.copy()
        for k in range(len(powers)):
            for p in POWERS:
                trial = powers.copy()
                trial[k] = p
                found = worth(trial)
                if found < best * (1 - 1e-12) or (found <= best * (1 + 1e-12) and p > powers[k]):  # of equals the smoother
                    best, powers = min(found, best), trial
        if np.array_equal(before, powers):
            break
    return tuple(10.0**powers)


def fit(g: Gram, names: Sequence[str] | None = None, *, smoothing: float | Sequence[float] | None = None, drop: bool = False,
        gamma: float | None = None) -> Fit:
    """Fit the named terms (all by default) from the cross products; no data are read.

    ``smoothing``: fixed parameters, or one for all; by default they are chosen
    by generalised cross-validation, in which a degree of freedom counts
    ``gamma`` times.  ``drop`` penalises the straight part of every term too,
    so that a term can shrink to nothing; ``gamma`` is then half the logarithm
    of the number of rows by default, else one.
    """
    chosen = g.columns(names)
    s = _system(g, chosen, drop)
    if smoothing is None:
        found = _choose(s, g.n, g.yy, (max(1.0, math.log(g.n) / 2) if drop else 1.0) if gamma is None else gamma)
    else:
        found = (float(smoothing),) * len(s.penalties) if isinstance(smoothing, (int, float)) else tuple(smoothing)
        if len(found) != len(s.penalties):
            raise ValueError(f"{len(s.penalties)} smoothing parameters wanted")
    beta, rss, edf = _solve(s, found, g.yy)
    raw = s.turn @ beta
    rss, edf = float(rss), float(edf)
    return Fit(tuple(t for t, _ in chosen), float(raw[0]), tuple(raw[at] for _, at in chosen), found, g.n, rss, edf)


def fit_gamma(df: DataFrame, terms: Sequence[Term], target: str, *, smoothing: float | Sequence[float] | None = None,
              drop: bool = False, gamma: float | None = None, rounds: int = 50, tolerance: float = 1e-10) -> Fit:
    """Gamma regression with log link, penalised; each round is one pass over the data.

    A round sums the cross products of the basis and the working response, and
    the deviance of the round before; it ends when the deviance stands still.
    Only positive targets take part.
    """
    arrays = _arrays(terms)
    y = F.col(target).cast("double")
    held = with_basis(df.where(y > 0), terms).select(*arrays, y.alias("__y")).persist()
    try:
        eta, deviance, found = F.log("__y"), math.inf, None
        for _ in range(rounds):
            ratio = F.col("__y") * F.exp(-eta)
            missed = F.sqrt(F.greatest(2 * (ratio - 1 - F.log(ratio)), F.lit(0.0)))
            whole = cross_products(held, arrays, eta + ratio - 1, missed)
            now = whole[-1, -1]
            if found is not None:
                found = replace(found, deviance=now)
                if abs(deviance - now) <= tolerance * (abs(now) + tolerance):
                    break
                deviance = now
            k = len(whole) - 2
            found = replace(fit(Gram(tuple(terms), whole[0, 0], whole[:k, :k], whole[:k, k], whole[k, k]), smoothing=smoothing,
                                drop=drop, gamma=gamma), link="log")
            eta = F.lit(found.intercept)
            for name, c in zip(arrays, found.coefficients):
                eta = eta + _dot(name, c)
    finally:
        held.unpersist()
    return found


def ladder(g: Gram, models: Mapping[str, Sequence[str]], **options) -> list[tuple[str, Fit]]:
    """Models by name, each a choice of terms, all from one table of cross products; best first by Akaike's criterion."""
    return sorted(((name, fit(g, names, **options)) for name, names in models.items()), key=lambda x: (x[1].aic, x[0]))
