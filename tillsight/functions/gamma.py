"""Log-gamma differences, the digamma and the trigamma function, for numbers, arrays and column expressions.

Spark SQL has none. All use the asymptotic series after moving the argument up by eight, which
leaves an error near 1e-14. The pieces are functions of ``z`` and of ``l = ln(z + 8)``,
``i = 1 / (z + 8)``, ``w = i * i``, so that a plan can compute those once as columns.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT = 8
# fixed values: coefficients of the asymptotic series in powers of 1/y^2
LOG_GAMMA_SERIES = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360]
DIGAMMA_SERIES = [-1 / 12, 1 / 120, -1 / 252, 1 / 240, -1 / 132, 691 / 32760]
TRIGAMMA_SERIES = [1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66, -691 / 2730]


def _log(value):
    return F.log(value) if isinstance(value, Column) else np.log(value)


def _log1p(value):
    return F.log1p(value) if isinstance(value, Column) else np.log1p(value)


def _polynomial(series, w):
    total = series[-1]
    for c in reversed(series[:-1]):
        total = total * w + c
    return total


def tail(i, w):
    """What Stirling's formula leaves out of ln Gamma(z + 8)."""
    return _polynomial(LOG_GAMMA_SERIES, w) * i


def digamma_of(z, l, i, w):
    below = 1.0 / z
    for k in range(1, SHIFT):
        below = below + 1.0 / (z + float(k))
    return l - 0.5 * i + _polynomial(DIGAMMA_SERIES, w) * w - below


def trigamma_of(z, i, w):
    below = 1.0 / (z * z)
    for k in range(1, SHIFT):
        below = below + 1.0 / ((z + float(k)) * (z + float(k)))
    return i + 0.5 * w + _polynomial(TRIGAMMA_SERIES, w) * w * i + below


def rise_of(z, d, l_end, tail_start, tail_end):
    """ln Gamma(z + d) - ln Gamma(z) for z > 0, d >= 0, without cancellation for large z.

    ``l_end`` and ``tail_end`` belong to z + d, ``tail_start`` to z.
    """
    y = z + float(SHIFT)
    product = 1.0 + d / z
    for k in range(1, SHIFT):
        product = product * (1.0 + d / (z + float(k)))
    return (y - 0.5) * _log1p(d / y) + d * l_end - d + tail_end - tail_start - _log(product)


def _pieces(z):
    i = 1.0 / (z + SHIFT)
    return np.log(z + SHIFT), i, i * i


def digamma(z):
    return digamma_of(z, *_pieces(z))


def trigamma(z):
    return trigamma_of(z, *_pieces(z)[1:])


def log_gamma_tail(z):
    return tail(*_pieces(z)[1:])


def log_gamma_rise(z, d):
    return rise_of(z, d, _pieces(z + d)[0], log_gamma_tail(z), log_gamma_tail(z + d))
