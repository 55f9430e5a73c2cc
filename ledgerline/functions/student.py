"""Two-sided p-value of a simple-regression slope, as a column expression.

Spark SQL has no Student t distribution. With nu = n - 2 and z = sqrt(-nu ln(1 - R^2)) the tail of
the slope's t statistic is Q(z) / Q(0), where

    Q(z) = integral from z on of exp(-x^2 / 2) h(x) dx,   h(x) = x / sqrt(1 - exp(-x^2 / nu)).

h is smooth and nearly flat, the normal tail's factor does the rest; so one Gauss-Legendre rule,
stretched to where the integrand falls below exp(-45) of its start, serves every sample size. The relative error
is some 1e-12 from three pairs to a million million, also where p is as small as 1e-300.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.scalars import let

NODES = 32
REACH = 45.0  # the integrand's exponent at the last node


@cache
def _rule() -> str:
    """The nodes and weights on [0, 1] as SQL text of an array of (v, w)."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    pairs = zip(((nodes + 1) / 2).tolist(), (weights / 2).tolist(), strict=True)
    return "array(" + ", ".join(f"named_struct('v', {v!r}D, 'w', {w!r}D)" for v, w in pairs) + ")"


def _scaled_tail(z: str, nu: str) -> str:
    """Q(z) exp(z^2 / 2) up to a factor that depends on nu alone."""
    at = f"({z} + width * x.v)"
    each = f"x.w * exp(-(width * x.v) * ({z} + width * x.v / 2)) * {at} / sqrt(-expm1(-({at} * {at}) / {nu}))"
    return let("width", f"sqrt({z} * {z} + {2 * REACH}D) - {z}", f"width * aggregate(rule, 0D, (total, x) -> total + {each})")


def slope_p_value(n: str, r_squared: str) -> Column:
    """p-value from the columns of the pair count and R^2; null where R^2 is null or there are fewer than three pairs."""
    # s.e is -z^2.
    tail = f"exp(s.e / 2) * {let('z', 'sqrt(-s.e)', _scaled_tail('z', 's.nu'))} / {_scaled_tail('0D', 's.nu')}"
    given = f"named_struct('nu', cast(`{n}` as double) - 2, 'e', (cast(`{n}` as double) - 2) * log1p(-`{r_squared}`))"
    inside = let("rule", _rule(), let("s", given, f"least({tail}, 1D)"))
    return F.expr(
        f"case when `{n}` > 2 and `{r_squared}` >= 0 and `{r_squared}` < 1 then {inside}"
        f" when `{n}` > 2 and `{r_squared}` = 1 then 0D end"
    )
