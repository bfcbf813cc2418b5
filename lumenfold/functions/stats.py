"""Student-t tail probability and guarded arithmetic as column expressions."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# A similarity up to this is the rounding noise of an exact zero.
ZERO = 1e-12

_TAIL_NODES = 64
_TAIL_END = 7.0
_CENTRE_NODES = 20
_SHIFT = 8


def correlation(covariance: Column, std_a: Column, std_b: Column) -> Column:
    """Correlation from population moments; null where a side is constant."""
    return F.try_divide(covariance, F.nullif(std_a * std_b, F.lit(0.0)))


def two_sided_p(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom.

    With C^2 = df / (df + t^2), the tail equals
    2 K C^df / df * integral over q >= 0 of 2q exp(-q^2) / sqrt(1 - C^2 exp(-2q^2/df)),
    where K = gamma((df+1)/2) / (sqrt(pi) gamma(df/2)). The integrand stays smooth
    for any df, so fixed Gauss-Legendre nodes keep full relative accuracy in
    the far tail. Below |t| = 1 the centre is integrated instead. Null where df <= 0
    or t is null; 0 for infinite t.
    """
    size, n = F.abs(t), F.when(df > 0, df.cast("double"))
    log_scale = F.log1p(size * size / n)

    def far(q: Column) -> Column:
        return 2.0 * q * F.exp(-q * q) / F.sqrt(-F.expm1(-log_scale - 2.0 * q * q / n))

    def near(u: Column) -> Column:
        return F.exp(-(n + 1.0) / 2.0 * F.log1p(size * size * u * u / n))

    log_k = _log_gamma_step(n / 2.0) - 0.5 * math.log(math.pi)
    tail = 2.0 * F.exp(log_k - n / 2.0 * log_scale) / n * _quadrature(far, _TAIL_NODES, _TAIL_END)
    centre = 2.0 * F.exp(log_k) / F.sqrt(n) * size * _quadrature(near, _CENTRE_NODES, 1.0)
    return (
        F.when(n.isNull() | t.isNull() | F.isnan(t), F.lit(None).cast("double"))
        .when(size == float("inf"), F.lit(0.0))
        .when(size < 1.0, 1.0 - centre)
        .otherwise(tail)
    )


def _quadrature(f, nodes: int, end: float) -> Column:
    """Integral of ``f`` over [0, end] by Gauss-Legendre with nodes known at plan time."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    pairs = zip((x + 1.0) * end / 2.0, w * end / 2.0)
    table = F.expr(f"array({', '.join(f'struct({float(a)!r}D AS x, {float(b)!r}D AS w)' for a, b in pairs)})")
    return F.aggregate(table, F.lit(0.0), lambda total, node: total + node["w"] * f(node["x"]))


def _log_gamma_step(a: Column) -> Column:
    """ln gamma(a + 1/2) - ln gamma(a): shift the argument up, then the asymptotic series."""
    low = sum((F.log((a + float(i)) / (a + i + 0.5)) for i in range(_SHIFT)), F.lit(0.0))
    z = a + float(_SHIFT)
    series = (
        0.5 * F.log(z)
        - 1.0 / (8.0 * z)
        + 1.0 / (192.0 * z**3)
        - 1.0 / (640.0 * z**5)
        + 17.0 / (14336.0 * z**7)
    )
    return low + series
