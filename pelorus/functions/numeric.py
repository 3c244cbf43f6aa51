"""Scalar column functions: vectors, weights, portable hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Norms below this are treated as this when normalising.
NORM_FLOOR = 1e-12

_MODULUS = 2147483648  # 2^31


def days_between(later: Column, earlier: Column) -> Column:
    """Fractional days from ``earlier`` to ``later``."""
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(86400e6)


def recency_weight(age_days: Column, decay: float) -> Column:
    """``exp(-decay * age)`` with negative ages counted as 0; a null age leaves the weight at 1."""
    if decay <= 0:
        return F.lit(1.0)
    return F.coalesce(F.exp(F.lit(-float(decay)) * F.greatest(F.lit(0.0), age_days)), F.lit(1.0))


def value_weight(column: Column, weights: dict[str, float] | None) -> Column:
    """Weight looked up by value, 1.0 for values outside the map."""
    out = F.lit(1.0)
    for value, weight in (weights or {}).items():
        out = F.when(column == F.lit(value), F.lit(float(weight))).otherwise(out)
    return out


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column) -> Column:
    # The norm is spread to an array first: inside a lambda it would be computed again for every element.
    norms = F.array_repeat(F.greatest(l2_norm(v), F.lit(NORM_FLOOR)), F.size(v))
    return F.zip_with(v, norms, lambda x, n: x.cast("double") / n)


def portable_hash(x: Column, seed: int = 0) -> Column:
    """Linear congruential hash to [0, 2^31) that any SQL engine reproduces; needs an integer ``x``."""
    folded = F.pmod(F.pmod(x, F.lit(_MODULUS)) + F.lit(seed % _MODULUS), F.lit(_MODULUS))
    once = F.pmod(folded * F.lit(1103515245) + F.lit(12345), F.lit(_MODULUS))
    return F.pmod(F.shiftright(once, 8) * F.lit(69069) + once, F.lit(_MODULUS))
