"""Scalar distribution functions for test statistics (driver side).

Spark computes the statistics; these turn the handful of resulting
scalars into p-values and quantiles. Standard numerical methods:
regularised incomplete gamma and beta (power series and continued fractions
evaluated bottom-up), Acklam's inverse normal refined by Newton, and
Gauss-Legendre quadrature for the studentised range.
"""

from __future__ import annotations

import math

import numpy as np

_FPMIN = 1e-300


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def norm_pdf(x: float) -> float:
    return math.exp(-0.5 * x * x) / math.sqrt(2 * math.pi)


def norm_ppf(p: float) -> float:
    if p <= 0:
        return -math.inf
    if p >= 1:
        return math.inf
    # Acklam's rational approximation
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00]
    lo = 0.02425
    if p < lo:
        q = math.sqrt(-2 * math.log(p))
        x = (((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / \
            ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    elif p > 1 - lo:
        q = math.sqrt(-2 * math.log(1 - p))
        x = -(((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / \
            ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    else:
        q = p - 0.5
        r = q * q
        x = (((((a[0] * r + a[1]) * r + a[2]) * r + a[3]) * r + a[4]) * r + a[5]) * q / \
            (((((b[0] * r + b[1]) * r + b[2]) * r + b[3]) * r + b[4]) * r + 1)
    for _ in range(2):  # Newton refinement
        e = norm_cdf(x) - p
        x -= e / max(norm_pdf(x), _FPMIN)
    return x


def _converged(value_at_depth) -> float:
    """Evaluate a continued fraction from the bottom up, twice as deep each
    time until two results agree."""
    depth, last = 16, math.nan
    while depth <= 1 << 20:
        value = value_at_depth(depth)
        if abs(value - last) <= 1e-14 * abs(value):
            return value
        depth, last = 2 * depth, value
    return last


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x), small values included.

    Up to a + 1 as 1 - P with the power series P = e^-x x^a sum x^n /
    Gamma(a + n + 1); beyond, e^-x x^a / Gamma(a) over the fraction
    x + 1 - a - 1 (1 - a) / (x + 3 - a - 2 (2 - a) / (x + 5 - a - ...)).
    """
    if x <= 0:
        return 1.0
    scale = a * math.log(x) - x
    if x <= a + 1:
        term = total = math.exp(scale - math.lgamma(a + 1))
        n = 0
        while term > total * 1e-17:
            n += 1
            term *= x / (a + n)
            total += term
        return max(0.0, 1.0 - total)

    def fraction(depth):
        value = x + 2 * depth + 1 - a
        for i in range(depth, 0, -1):
            value = x + 2 * i - 1 - a + i * (a - i) / value
        return value

    return math.exp(scale - math.lgamma(a)) / _converged(fraction)


def chi2_sf(x: float, k: float) -> float:
    return gamma_upper(k / 2.0, x / 2.0)


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b).

    x^a (1 - x)^b / (a B(a, b)) over the fraction 1 + d1 / (1 + d2 / ...)
    with d(2m) = m (b - m) x / ((a + 2m - 1) (a + 2m)) and
    d(2m + 1) = -(a + m) (a + b + m) x / ((a + 2m) (a + 2m + 1)), below the
    mean; beyond it by symmetry.
    """
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - betainc(b, a, 1.0 - x)

    def coefficient(i):
        m, odd = divmod(i, 2)
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))

    def fraction(depth):
        value = 1.0
        for i in range(depth, 0, -1):
            value = 1.0 + coefficient(i) / value
        return value

    log_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                 + a * math.log(x) + b * math.log1p(-x))
    return math.exp(log_front) / (a * _converged(fraction))


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value."""
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_cdf(t: float, df: float) -> float:
    tail = 0.5 * t_sf2(t, df)
    return 1 - tail if t > 0 else tail


def t_ppf(p: float, df: float) -> float:
    """Quantile by bisection, inside a bracket that grows until it holds it."""
    if p < 0.5:
        return -t_ppf(1 - p, df)
    lo, hi = 0.0, 1.0
    while t_sf2(hi, df) / 2 > 1 - p:
        lo, hi = hi, 2 * hi
        if math.isinf(hi):
            return hi
    while hi - lo > 1e-13 * hi:
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if t_sf2(mid, df) / 2 > 1 - p else (lo, mid)
    return (lo + hi) / 2


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail, from the tail itself so that small values survive."""
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d1 * f + d2))


_GL_X, _GL_W = np.polynomial.legendre.leggauss(48)


_erfc = np.frompyfunc(math.erfc, 1, 1)


def _phi_vec(x: np.ndarray) -> np.ndarray:
    """Normal CDF by element, to machine precision."""
    return 0.5 * _erfc(-np.asarray(x) / math.sqrt(2.0)).astype(float)


def _nodes(a, b):
    return 0.5 * (b - a) * _GL_X + 0.5 * (b + a), 0.5 * (b - a) * _GL_W


def _range_cdf_inf_vec(w: np.ndarray, k: int) -> np.ndarray:
    """P(range of k standard normals < w) for an array of w."""
    w = np.asarray(w, dtype=float)
    zs, ws = [], []
    for a, b in zip(np.linspace(-8.5, 8.5, 9)[:-1], np.linspace(-8.5, 8.5, 9)[1:]):
        x, wt = _nodes(a, b)
        zs.append(x)
        ws.append(wt)
    z = np.concatenate(zs)[None, :]
    wt = np.concatenate(ws)[None, :]
    ww = w[:, None]
    inner = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi) * \
        np.clip(_phi_vec(z) - _phi_vec(z - ww), 0, 1) ** (k - 1)
    out = k * np.sum(inner * wt, axis=1)
    return np.clip(np.where(w > 0, out, 0.0), 0.0, 1.0)


def ptukey(q: float, k: int, df: float) -> float:
    """CDF of the studentised range with k groups and df degrees of freedom:
    the infinite-df range CDF integrated over the density of
    s = sqrt(chi2_df / df) (Gauss-Legendre on both levels)."""
    if q <= 0:
        return 0.0
    # the density of s stands around 1 with a deviation of 1 / sqrt(2 df)
    reach = 10 / math.sqrt(2 * df)
    ss, wts = [], []
    marks = np.linspace(max(1e-9, 1 - reach), 1 + reach, 5)
    for a, b in zip(marks[:-1], marks[1:]):
        x, wt = _nodes(a, b)
        ss.append(x)
        wts.append(wt)
    s = np.concatenate(ss)
    wt = np.concatenate(wts)
    logd = (math.log(2) + (df / 2) * math.log(df / 2) - math.lgamma(df / 2)
            + (df - 1) * np.log(s) - df * s * s / 2)
    total = float(np.sum(np.exp(logd) * _range_cdf_inf_vec(q * s, k) * wt))
    return min(1.0, max(0.0, total))
