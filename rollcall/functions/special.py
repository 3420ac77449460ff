"""Special functions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below SWITCH the series, from there on the continued fraction; with these lengths both are good to 1e-15.
SWITCH, TERMS, DEPTH = 2.0, 48, 70


def erfc(z: Column) -> Column:
    """1 - erf(z) for z >= 0; NULL stays NULL.

    erf is e^(-z²) 2z / sqrt(pi) times the sum of (2z²)^k / (1·3·5···(2k + 1)), all of
    whose terms are positive; erfc is e^(-z²) / (z sqrt(pi)) divided by
    1 + q / (1 + 2q / (1 + 3q / ...)) with q = 1 / (2z²).
    """
    square = z * z
    # Folded from the last term on, so the expression stays small.
    down = lambda n: F.sequence(F.lit(n), F.lit(1), F.lit(-1))
    series = F.aggregate(down(TERMS), F.lit(1.0), lambda acc, k: 1 + acc * square * (2.0 / (2 * k + 1)))
    near = 1 - F.exp(-square) * z * series * (2 / math.sqrt(math.pi))
    fraction = F.aggregate(down(DEPTH), F.lit(1.0), lambda acc, k: 1 + k / (2 * square) / acc)
    far = F.exp(-square) / (z * math.sqrt(math.pi) * fraction)
    return F.when(z < SWITCH, near).otherwise(far)


def chi2_tail(stat: Column) -> Column:
    """P(chi-square with one degree of freedom > stat)."""
    return erfc(F.sqrt(stat / 2))
