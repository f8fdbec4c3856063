"""Numerical helpers for the statistics operators, as Column expressions.

``ln_gamma`` is plain arithmetic (codegen). The chi-square upper tail is the
regularized upper incomplete gamma function Q(dof/2, stat/2), evaluated with
its power series (x < a + 1) or its continued fraction (x >= a + 1), each as
an ``aggregate`` over a sequence whose length grows with sqrt(a), as the terms
that either needs do: JVM-side, no Python worker.
``chi2_sf_numpy`` (closed forms with ``erfc``) is the independent check used
by the tests.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_HALF_LN_2PI = 0.5 * math.log(2.0 * math.pi)
# Shift used by ln_gamma: lnG(x) = lnG(x + 8) - ln(x (x+1) ... (x+7)).
_SHIFT = 8
# Coefficients of the Stirling series, of alternating sign.
_STIRLING = [1.0 / 12.0, 1.0 / 360.0, 1.0 / 1260.0, 1.0 / 1680.0, 1.0 / 1188.0, 691.0 / 360360.0, 1.0 / 156.0]


def ln_gamma(x: Column) -> Column:
    """Natural log of the gamma function for x > 0 as a Column expression.

    Stirling series to the y^-13 term at y = x + 8 (truncation below 1e-15),
    then lnG(x) = lnG(x + 8) - ln(x (x+1) ... (x+7)), the product taken as a
    sum of logs so it cannot overflow.
    """
    y = x + F.lit(float(_SHIFT))
    inv = F.lit(1.0) / y
    inv2 = inv * inv
    series = F.lit(_STIRLING[-1])
    for c in reversed(_STIRLING[:-1]):
        series = F.lit(c) - inv2 * series
    series = inv * series
    stirling = (y - F.lit(0.5)) * F.log(y) - y + F.lit(_HALF_LN_2PI) + series
    shift = F.log(x)
    for k in range(1, _SHIFT):
        shift = shift + F.log(x + F.lit(float(k)))
    return stirling - shift


def ln_beta(a: Column, b: Column) -> Column:
    return ln_gamma(a) + ln_gamma(b) - ln_gamma(a + b)


def ln_gamma_text(x: str) -> str:
    """``ln_gamma`` of a column as SQL text: built at once, where an expression of Columns is built call by call."""
    y = f"({x} + {float(_SHIFT)!r}D)"
    series = f"{_STIRLING[-1]!r}D"
    for c in reversed(_STIRLING[:-1]):
        series = f"({c!r}D - {series} / ({y} * {y}))"
    shift = " - ".join(f"ln({x} + {float(k)!r}D)" for k in range(_SHIFT))
    return f"(({y} - 0.5D) * ln({y}) - {y} + {_HALF_LN_2PI!r}D + {series} / {y} - {shift})"


def ln_beta_text(a: str, b: str) -> str:
    return f"({ln_gamma_text(a)} + {ln_gamma_text(b)} - {ln_gamma_text(f'({a} + {b})')})"


def chi2_sf_numpy(stat: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """Upper tail P(X >= stat) of a chi-square with integer ``dof``.

    Closed forms: x = stat / 2, k = dof.
      k = 0      -> 1
      k even     -> e^-x * sum_{j < k/2} x^j / j!
      k odd      -> erfc(sqrt x) + e^-x * sum_{j=1}^{(k-1)/2} x^(j-1/2) / G(j+1/2)
    Terms are summed in log space so large statistics do not overflow.
    """
    out = np.empty(len(stat), dtype="float64")
    for i, (s, k) in enumerate(zip(stat, dof)):
        if s is None or k is None or (isinstance(s, float) and math.isnan(s)) or pd.isna(k):
            out[i] = np.nan
            continue
        k = int(k)
        x = max(float(s), 0.0) / 2.0
        if k <= 0:
            out[i] = 1.0
            continue
        if k % 2 == 0:
            if x == 0.0:
                out[i] = 1.0
                continue
            lx = math.log(x)
            total = 0.0
            for j in range(k // 2):
                total += math.exp(j * lx - x - math.lgamma(j + 1))
            out[i] = min(total, 1.0)
        else:
            total = math.erfc(math.sqrt(x))
            if x > 0.0:
                lx = math.log(x)
                for j in range(1, (k - 1) // 2 + 1):
                    total += math.exp((j - 0.5) * lx - x - math.lgamma(j + 0.5))
            out[i] = min(total, 1.0)
    return out


# Terms: the series' n-th term near x = a falls as exp(-n^2 / 2a), so 12 sqrt(a)
# of them reach below 1e-30; the constant covers small a.
_TERMS = 300
_TERMS_PER_ROOT = 12
_TINY = 1e-300
# Steps of the continued fraction, two of which are a term of its usual form.
_BETA_TERMS = 80
_BETA_TERMS_PER_ROOT = 3


def gamma_q(a: Column, x: Column, terms: int = _TERMS) -> Column:
    """Regularized upper incomplete gamma Q(a, x) for a > 0, x >= 0."""
    steps = F.sequence(F.lit(1), F.lit(terms) + F.ceil(F.sqrt(a) * F.lit(_TERMS_PER_ROOT)).cast("int"))
    log_front = F.log(x) * a - x  # x^a e^-x, in logs

    # Power series: P(a, x) = x^a e^-x / G(a+1) * sum_n x^n / ((a+1)...(a+n)).
    series = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
        lambda acc, n: F.struct(
            (acc["t"] * x / (a + n)).alias("t"),
            (acc["s"] + acc["t"] * x / (a + n)).alias("s"),
        ),
    )
    q_series = F.lit(1.0) - F.exp(log_front - ln_gamma(a + F.lit(1.0))) * series["s"]

    # Continued fraction (modified Lentz): Q(a, x) = x^a e^-x / G(a) * h.
    b0 = x + F.lit(1.0) - a

    def lentz(acc, i):
        an = -i * (i - a)
        b = b0 + F.lit(2.0) * i
        d = an * acc["d"] + b
        d = F.when(F.abs(d) < F.lit(_TINY), F.lit(_TINY)).otherwise(d)
        c = b + an / acc["c"]
        c = F.when(F.abs(c) < F.lit(_TINY), F.lit(_TINY)).otherwise(c)
        d = F.lit(1.0) / d
        return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * d * c).alias("h"))

    start = F.struct(
        F.lit(1.0 / _TINY).alias("c"), (F.lit(1.0) / b0).alias("d"), (F.lit(1.0) / b0).alias("h")
    )
    cf = F.aggregate(steps, start, lentz)
    q_cf = F.exp(log_front - ln_gamma(a)) * cf["h"]

    q = F.when(x <= F.lit(0.0), F.lit(1.0)).when(x < a + F.lit(1.0), q_series).otherwise(q_cf)
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))


def beta_cdf(x: Column, a: Column, b: Column) -> Column:
    """Regularized incomplete beta I_x(a, b) for a, b > 0; 0 and 1 outside (0, 1).

    Continued fraction (modified Lentz) on the side of the mean where it
    converges fast, 1 - I_{1-x}(b, a) on the other; its length grows with
    sqrt(a + b), as the terms it needs do.
    """
    flip = x > (a + F.lit(1.0)) / (a + b + F.lit(2.0))
    p, q = F.when(flip, b).otherwise(a), F.when(flip, a).otherwise(b)
    z = F.when(flip, F.lit(1.0) - x).otherwise(x)
    steps = F.sequence(F.lit(2), F.lit(_BETA_TERMS) + F.ceil(F.sqrt(a + b) * F.lit(_BETA_TERMS_PER_ROOT)).cast("int"))

    def lentz(acc, n):
        m = F.floor(n / 2)
        even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
        k = F.when(n % 2 == 0, even).otherwise(odd)
        # the product takes the former step's factors, so that no expression is evaluated for two fields
        return F.struct(
            (F.lit(1.0) + k / acc["c"] + F.lit(_TINY)).alias("c"),
            (F.lit(1.0) / (F.lit(1.0) + k * acc["d"] + F.lit(_TINY))).alias("d"),
            (acc["h"] * acc["c"] * acc["d"]).alias("h"),
        )

    first = F.lit(1.0) / (F.lit(1.0) - (p + q) * z / (p + 1) + F.lit(_TINY))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), F.lit(1.0).alias("h"))
    last = F.aggregate(steps, start, lentz, lambda acc: acc["h"] * acc["c"] * acc["d"])
    front = F.exp(p * F.log(z) + q * F.log(F.lit(1.0) - z) - ln_beta(p, q)) / p
    part = F.least(F.greatest(front * last, F.lit(0.0)), F.lit(1.0))
    inside = F.when(flip, F.lit(1.0) - part).otherwise(part)
    return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).otherwise(inside)


def chi2_sf(stat: Column, dof: Column) -> Column:
    """Upper tail P(X >= stat) of a chi-square with ``dof`` degrees of
    freedom; dof 0 gives 1."""
    a = dof.cast("double") / F.lit(2.0)
    x = stat.cast("double") / F.lit(2.0)
    return F.when(dof <= 0, F.lit(1.0)).otherwise(gamma_q(a, x))
