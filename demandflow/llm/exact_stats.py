"""Column expressions for exact discrete distributions, in log space."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, shifted by one for small n (error below 1e-5)."""
    z = n + 2.0
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5))) - F.ln(n + 1.0)


def binomial_lower_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p) and k below its mean; terms further than 12 deviations below k are left out."""
    first = F.greatest(F.lit(0.0), k - 12 * F.sqrt(n * p) - 40)
    terms = F.transform(F.sequence(first.cast("long"), k.cast("long")), lambda i: F.exp(
        log_factorial(n) - log_factorial(i.cast("double")) - log_factorial(n - i) + i * math.log(p) + (n - i) * math.log1p(-p)))
    return F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)
