"""p-values as Column expressions: Kolmogorov's limit, the chi-squared and the normal distribution."""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: FIXED VALUES: Lanczos coefficients of the gamma function for g = 7.
_LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
            12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def kolmogorov_sf(x: Column) -> Column:
    """P(K > x) = 2 Σ (-1)^(j-1) exp(-2 j² x²); below 1 by the theta-transformed series, which
    converges there at once."""
    far = reduce(lambda a, b: a + b, [F.lit(2.0 * (-1) ** (j - 1)) * F.exp(F.lit(-2.0 * j * j) * x * x) for j in range(1, 9)])
    inner = reduce(lambda a, b: a + b, [F.exp(F.lit(-((2 * j - 1) * math.pi) ** 2 / 8) / (x * x)) for j in range(1, 6)])
    near = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / x * inner
    return F.when(x <= 0.05, 1.0).when(x < 1, near).otherwise(F.least(F.greatest(far, F.lit(0.0)), F.lit(1.0)))


def log_gamma(a: Column) -> Column:
    """ln Γ(a) for a > 0 (Lanczos)."""
    z = a - 1
    series = reduce(lambda s, t: s + t, [F.lit(c) / (z + i) for i, c in enumerate(_LANCZOS) if i], F.lit(_LANCZOS[0]))
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.log(t) - t + F.log(series)


def gamma_q(a: Column, x: Column, terms: int = 300) -> Column:
    """Upper regularised incomplete gamma function Q(a, x): the power series of P below a + 1,
    the continued fraction (modified Lentz) above."""
    steps = F.sequence(F.lit(1), F.lit(terms))
    a, x = a.cast("double"), x.cast("double")
    scale = F.exp(a * F.log(x) - x - log_gamma(a))
    first = F.struct((F.lit(1.0) / a).alias("term"), (F.lit(1.0) / a).alias("total"))

    def add(s: Column, n: Column) -> Column:
        term = s["term"] * x / (a + n)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    p = scale * F.aggregate(steps, first, add)["total"]
    tiny = F.lit(1e-300)
    start = x + 1 - a
    begin = F.struct((F.lit(1.0) / tiny).alias("c"), (F.lit(1.0) / start).alias("d"), (F.lit(1.0) / start).alias("h"))

    def lentz(s: Column, i: Column) -> Column:
        an, b = -i * (i - a), x + 1 - a + i * 2
        d = an * s["d"] + b
        d = F.lit(1.0) / F.when(F.abs(d) < tiny, tiny).otherwise(d)
        c = b + an / s["c"]
        c = F.when(F.abs(c) < tiny, tiny).otherwise(c)
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    q = scale * F.aggregate(steps, begin, lentz)["h"]
    return F.when(x <= 0, 1.0).when(x < a + 1, F.lit(1.0) - p).otherwise(q)


def chi2_sf(x: Column, degrees: Column) -> Column:
    """P(χ² > x)."""
    return gamma_q(degrees / 2, x / 2)


def normal_two_sided(z: Column) -> Column:
    """P(|Z| > |z|)."""
    return gamma_q(F.lit(0.5), z * z / 2)
