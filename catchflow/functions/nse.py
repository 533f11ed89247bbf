"""Nash-Sutcliffe efficiency as aggregate expressions (A4, A5; F5).

Both are one-pass, partial-aggregatable expressions: ``sum((o - mean(o))^2) = var_pop(o) * count(o)``.
NULL where the reference yields NaN or inf (constant observations, nothing matched).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sse(obs: Column | str, sim: Column | str) -> Column:
    o = F.col(obs) if isinstance(obs, str) else obs
    s = F.col(sim) if isinstance(sim, str) else sim
    return F.sum(F.pow(o - s, 2))


def obs_ss(obs: Column | str) -> Column:
    """Sum of squared deviations of ``obs`` from its mean, in one pass."""
    o = F.col(obs) if isinstance(obs, str) else obs
    return F.var_pop(o) * F.count(o)


def nse(obs: Column | str, sim: Column | str) -> Column:
    """A4 (masked): over rows where both are present; mean of the matched observations.

    Callers pass rows of an inner join with NULLs already dropped (P12); rows with a NULL side are
    ignored here too, so the expression is safe either way.
    """
    o = F.col(obs) if isinstance(obs, str) else obs
    s = F.col(sim) if isinstance(sim, str) else sim
    both = o.isNotNull() & s.isNotNull()
    om, sm = F.when(both, o), F.when(both, s)
    den = obs_ss(om)
    return F.when(den > 0, F.lit(1.0) - F.try_divide(sse(om, sm), den))
