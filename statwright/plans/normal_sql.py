"""SQL text of the normal distribution and of what rests on it, for the SQL
twins.  ``x`` and the like are names of columns."""

from __future__ import annotations

from collections.abc import Sequence

from ..functions import normal as N

ROOT_HALF = 0.5 ** 0.5


def poly(x: str, coefficients: Sequence[float]) -> str:
    out = repr(float(coefficients[0])) + "::DOUBLE"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {float(c)!r}::DOUBLE)"
    return out


def ratio(x: str, top: Sequence[float], bottom: Sequence[float]) -> str:
    return f"({poly(x, top)} / {poly(x, bottom)})"


def erfc(x: str) -> str:
    y, s = f"abs({x})", f"({x} * {x})"
    near = f"1 - {x} * {ratio(s, N.ERF_NUMERATOR, N.ERF_DENOMINATOR)}"
    middle = f"exp(-{s}) * {ratio(y, N.MIDDLE_NUMERATOR, N.MIDDLE_DENOMINATOR)}"
    far = f"exp(-{s}) * (0.5641895835477562869 - {ratio(f'(1 / {s})', N.FAR_NUMERATOR, N.FAR_DENOMINATOR)} / {s}) / {y}"
    beyond = f"CASE WHEN {y} <= 4 THEN {middle} ELSE {far} END"
    return f"CASE WHEN {y} <= 0.46875 THEN {near} WHEN {x} > 0 THEN {beyond} ELSE 2 - {beyond} END"


def cdf(z: str) -> str:
    return f"(0.5 * {erfc(f'(-{z} * {ROOT_HALF!r})')})"


def tail(z: str) -> str:
    return f"(0.5 * {erfc(f'({z} * {ROOT_HALF!r})')})"


def quantile(p: str) -> str:
    r = f"(0.180625 - ({p} - 0.5) * ({p} - 0.5))"
    far = f"sqrt(-ln(least({p}, 1 - {p})))"
    beyond = (f"CASE WHEN {far} <= 5 THEN {ratio(f'({far} - 1.6)', N.TAIL_NUMERATOR, N.TAIL_DENOMINATOR)} "
              f"ELSE {ratio(f'({far} - 5)', N.EXTREME_NUMERATOR, N.EXTREME_DENOMINATOR)} END")
    return f"(CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {ratio(r, N.CENTRE_NUMERATOR, N.CENTRE_DENOMINATOR)} ELSE sign({p} - 0.5) * ({beyond}) END)"


def shapiro(rows: str) -> str:
    """variable, n, statistic, p_value of (variable, v) rows, for 12 values or more with some spread."""
    last = poly("u", [-2.706056, 4.434685, -2.071190, -0.147981, 0.221157])
    second = poly("u", [-3.582633, 5.682633, -1.752461, -0.293762, 0.042981])
    mean, spread = poly("ln(n)", [0.0038915, -0.083751, -0.31082, -1.5861]), poly("ln(n)", [0.0030302, -0.082676, -0.4803])
    return f"""(SELECT variable, n, w AS statistic, {tail('z')} AS p_value FROM (SELECT *, (ln(1 - w) - {mean}) / exp({spread}) AS z FROM (
  SELECT variable, n, pow(middle / sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) + a1 * (x1 - y1) + a2 * (x2 - y2), 2) / ss AS w FROM (
    SELECT *, {last} * u + m1 / sqrt(mm) AS a1, {second} * u + m2 / sqrt(mm) AS a2 FROM (
      SELECT variable, any_value(n)::DOUBLE AS n, 1 / sqrt(any_value(n)) AS u, sum(m * m) AS mm, sum(x * x) AS ss, sum(m * x) FILTER (i > 2 AND i < n - 1) AS middle,
        max(m) FILTER (i = n) AS m1, max(m) FILTER (i = n - 1) AS m2, max(x) FILTER (i = n) AS x1, max(x) FILTER (i = n - 1) AS x2,
        max(x) FILTER (i = 1) AS y1, max(x) FILTER (i = 2) AS y2 FROM (
        SELECT *, {quantile('p')} AS m FROM (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM (
          SELECT variable, v - avg(v) OVER (PARTITION BY variable) AS x, row_number() OVER (PARTITION BY variable ORDER BY v) AS i,
            count(*) OVER (PARTITION BY variable) AS n FROM ({rows})))) GROUP BY variable)))))"""


def kolmogorov_tail(d: str, n: str) -> str:
    """Large-sample tail with the small-sample argument."""
    x = f"((sqrt({n}) + 0.12 + 0.11 / sqrt({n})) * {d})"
    return (f"(CASE WHEN {x} < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101), "
            f"lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * {x} * {x}))))) END)")
