"""Column-expression helpers (JVM side, codegen friendly). No Python UDFs here."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(a, b) -> Column:
    """a / b, null when b is 0 or null (ANSI mode raises on x/0)."""
    return F.try_divide(c(a), c(b))


def pos_part(x) -> Column:
    """max(x, 0) that keeps null as null (``greatest`` would return 0 for null)."""
    x = c(x)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.greatest(x, F.lit(0.0)))


def rnd(x, digits: int = 6) -> Column:
    return F.round(c(x), digits)


def chi2_sf_even(q, dof: int) -> Column:
    """Upper tail of the chi-square distribution for an even number of degrees of freedom:
    exp(-q/2) * sum_{j < dof/2} (q/2)^j / j!  (closed form, no special functions needed)."""
    if dof % 2:
        raise ValueError("closed form needs even degrees of freedom")
    h = c(q) / 2.0
    terms = [F.pow(h, F.lit(float(j))) / float(math.factorial(j)) for j in range(dof // 2)]
    s = terms[0]
    for t in terms[1:]:
        s = s + t
    return F.exp(-h) * s


def path_stem(path) -> Column:
    """File name without folder and ``.csv`` suffix; accepts ``/`` and ``\\`` separators."""
    last = F.element_at(F.split(c(path), r"[/\\]"), -1)
    return F.regexp_replace(last, r"\.csv$", "")
