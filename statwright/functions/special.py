"""Distribution functions of single numbers, used on a few statistics at the
end of a job (there is no SciPy in the environment)."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np

_norm = NormalDist()


def norm_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    return _norm.inv_cdf(p)


def gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma."""
    if x <= 0:
        return 0.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return min(1.0, scale * total)
    return max(0.0, 1.0 - scale * _gamma_fraction(a, x))


def gamma_q(a: float, x: float) -> float:
    if x < a + 1:
        return 1.0 - gamma_p(a, x)
    return math.exp(a * math.log(x) - x - math.lgamma(a)) * _gamma_fraction(a, x)


def _gamma_fraction(a: float, x: float) -> float:
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def beta_i(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_i(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 100_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h / a


def chi2_cdf(x: float, df: float) -> float:
    return gamma_p(df / 2, x / 2)


def chi2_sf(x: float, df: float) -> float:
    return gamma_q(df / 2, x / 2) if x > 0 else 1.0


def f_sf(x: float, d1: float, d2: float) -> float:
    return beta_i(d2 / 2, d1 / 2, d2 / (d2 + d1 * x)) if x > 0 else 1.0


def t_two_sided(t: float, df: float) -> float:
    """Two-sided p-value."""
    return beta_i(df / 2, 0.5, df / (df + t * t))


def t_cdf(t: float, df: float) -> float:
    tail = 0.5 * t_two_sided(t, df)
    return 1 - tail if t > 0 else tail


def _bisect(f, low: float, high: float) -> float:
    for _ in range(200):
        mid = 0.5 * (low + high)
        if f(mid) < 0:
            low = mid
        else:
            high = mid
        if high - low <= 1e-15 * max(1.0, abs(mid)):
            break
    return 0.5 * (low + high)


def t_ppf(p: float, df: float) -> float:
    if p < 0.5:
        return -t_ppf(1 - p, df)
    high = 1.0
    while t_cdf(high, df) < p:
        high *= 2
    return _bisect(lambda t: t_cdf(t, df) - p, 0.0, high)


def chi2_ppf(p: float, df: float) -> float:
    high = max(1.0, df)
    while chi2_cdf(high, df) < p:
        high *= 2
    return _bisect(lambda x: chi2_cdf(x, df) - p, 0.0, high)


def kolmogorov_sf(d: float, n: int) -> float:
    """Tail of the one-sample Kolmogorov-Smirnov statistic, large-sample form
    with the usual small-sample correction of the argument."""
    root = math.sqrt(n)
    x = (root + 0.12 + 0.11 / root) * d
    if x < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * total))


def studentized_range_sf(q: float, groups: int, df: float) -> float:
    """P(range of ``groups`` normals / independent scale > q), by quadrature."""
    if q <= 0:
        return 1.0
    z, wz = np.polynomial.legendre.leggauss(160)
    z, wz = 8 * z, 8 * wz
    density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    cdf = np.vectorize(norm_cdf)

    def range_cdf(width: float) -> float:
        inside = np.clip(cdf(z + width) - cdf(z), 0, 1)
        return float(groups * np.sum(wz * density * inside ** (groups - 1)))

    if df > 20_000:
        return max(0.0, 1 - range_cdf(q))
    s, ws = np.polynomial.legendre.leggauss(80)
    spread = 8 / math.sqrt(2 * df)
    low, high = max(1e-9, 1 - spread), 1 + max(spread, 3 / math.sqrt(df))
    s, ws = low + (s + 1) * (high - low) / 2, ws * (high - low) / 2
    log_density = (math.log(2) + df / 2 * math.log(df / 2) - math.lgamma(df / 2)
                   + (df - 1) * np.log(s) - df * s * s / 2)
    total = sum(w * math.exp(ld) * range_cdf(q * x) for x, w, ld in zip(s, ws, log_density))
    return min(1.0, max(0.0, 1 - total))


def shapiro_wilk(values: np.ndarray) -> tuple[float, float]:
    """W and p by Royston's approximation, for 3 to 5000 values."""
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    m = np.array([norm_ppf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    mm = float(m @ m)
    u = 1 / math.sqrt(n)
    a = m / math.sqrt(mm)
    if n == 3:
        a = np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    else:
        # fixed polynomial coefficients of the published approximation
        last = np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, a[-1]], u)
        if n > 5:
            second = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, a[-2]], u)
            rest = (mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last ** 2 - 2 * second ** 2)
            a = m / math.sqrt(rest)
            a[-1], a[-2], a[0], a[1] = last, second, -last, -second
        else:
            rest = (mm - 2 * m[-1] ** 2) / (1 - 2 * last ** 2)
            a = m / math.sqrt(rest)
            a[-1], a[0] = last, -last
    spread = float(np.sum((x - x.mean()) ** 2))
    if spread == 0:
        return 1.0, 1.0
    w = min(1.0, float(a @ x) ** 2 / spread)
    if n == 3:
        p = 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return w, min(1.0, max(0.0, p))
    if w >= 1.0:
        return 1.0, 1.0
    y = math.log(1 - w)
    if n <= 11:
        gamma = -2.273 + 0.459 * n
        if y >= gamma:
            return w, 0.0
        y = -math.log(gamma - y)
        mu = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)
        sigma = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        ln = math.log(n)
        mu = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], ln)
        sigma = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], ln))
    return w, norm_sf((y - mu) / sigma)


def dagostino_k2(n: int, skew: float, kurt: float) -> tuple[float, float]:
    """K squared and p from n and the population skewness and excess kurtosis."""
    y = skew * math.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)
             / ((n - 2) * (n + 5) * (n + 7) * (n + 9)))
    w2 = -1 + math.sqrt(2 * (beta2 - 1))
    delta = 1 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2 / (w2 - 1))
    z1 = delta * math.asinh(y / alpha) if y else 0.0
    expected = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (kurt + 3 - expected) / math.sqrt(variance)
    root_beta1 = (6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
                  * math.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))))
    a = 6 + 8 / root_beta1 * (2 / root_beta1 + math.sqrt(1 + 4 / root_beta1 ** 2))
    denominator = 1 + x * math.sqrt(2 / (a - 4))
    term = math.copysign(abs((1 - 2 / a) / denominator) ** (1 / 3), denominator)
    z2 = (1 - 2 / (9 * a) - term) / math.sqrt(2 / (9 * a))
    k2 = z1 * z1 + z2 * z2
    return k2, math.exp(-k2 / 2)
