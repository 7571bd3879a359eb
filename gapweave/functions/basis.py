"""Bases of smooth effects as Column expressions; a missing input gives an array of NULLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _reach(t: Column) -> tuple[Column, Column]:
    s = F.abs(t)
    return F.greatest(2 - s, F.lit(0.0)), F.greatest(1 - s, F.lit(0.0))


def bump(t: Column) -> Column:
    """Cubic B-spline with unit knots around zero; sums to one over the whole numbers."""
    p, q = _reach(t)
    return (p * p * p - 4 * (q * q * q)) / 6 + t * 0.0  # the last part keeps a missing input missing


def bump_slope(t: Column) -> Column:
    p, q = _reach(t)
    return F.signum(t) * (2 * (q * q) - p * p / 2)


def on_steps(x: Column, low: float, high: float, k: int) -> tuple[Column, Column]:
    """Place on the ``k - 3`` steps from ``low`` to ``high``, and how far the value lies beyond them."""
    u = (x - low) / ((high - low) / (k - 3) or 1.0)
    inside = F.when(u < 0, F.lit(0.0)).when(u > k - 3, F.lit(float(k - 3))).otherwise(u)
    return inside, u - inside


def spline(inside: Column, beyond: Column, k: int) -> Column:
    """``k`` cubic B-splines at a place ``on_steps``; beyond the steps straight on."""
    return F.array(*[bump(inside - (j - 1)) + beyond * bump_slope(inside - (j - 1)) for j in range(k)])


def on_ring(x: Column, low: float, period: float, k: int) -> Column:
    return F.pmod((x - low) / period * k, F.lit(float(k)))


def ring(u: Column, k: int) -> Column:
    """``k`` cubic B-splines at a place ``on_ring``: value, slope and bend are equal at both ends of the period."""
    half = k / 2
    return F.array(*[bump(F.pmod(u - (j - half), F.lit(float(k))) - half) for j in range(k)])


def radial(xs: Sequence[Column], knots: Sequence[Sequence[float]]) -> Column:
    """Thin plates ``r^2 log r`` around the knots, then the coordinates themselves."""
    plates = []
    for knot in knots:
        r2 = sum(((x - c) * (x - c) for x, c in zip(xs, knot)), F.lit(0.0))
        plates.append(F.when(r2 > 0, r2 * F.log(r2) / 2).when(r2.isNotNull(), F.lit(0.0)))
    return F.array(*plates, *xs)


def products(a: str, n: int, b: str, m: int) -> Column:
    """All products of the entries of two array columns."""
    return F.array(*[F.get(a, F.lit(i)) * F.get(b, F.lit(j)) for i in range(n) for j in range(m)])
