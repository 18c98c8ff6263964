"""Money, rates and scores.

Amounts are DECIMAL(18,4): sums are then exact and independent of how rows are spread over
tasks. Rates are quotients taken in double and rounded through DECIMAL, which rounds halves
away from zero on the printed value and not on its binary neighbour.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def half_up(c: Column, places: int) -> Column:
    """Round a double (or decimal) half away from zero; the result is double."""
    return F.round(c.cast("decimal(24,12)"), places).cast("double")


def quotient(numerator: Column, denominator: Column) -> Column:
    """Unrounded double quotient, NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rate(numerator: Column, denominator: Column, places: int = 6) -> Column:
    return half_up(quotient(numerator, denominator), places)


def count_where(condition: Column) -> Column:
    """Number of rows meeting the condition (0 when none do)."""
    return F.count_if(condition)


def sum_where(value: Column, condition: Column) -> Column:
    """Sum over the rows meeting the condition; NULL when none do."""
    return F.sum(F.when(condition, value))


def band(value: Column, limits: tuple[tuple[float, str], ...], otherwise: str) -> Column:
    """Name of the first limit that is not exceeded; unknown values take ``otherwise``."""
    (bound, name), *rest = limits
    chain = F.when(value <= F.lit(bound), F.lit(name))
    for bound, name in rest:
        chain = chain.when(value <= F.lit(bound), F.lit(name))
    return chain.otherwise(F.lit(otherwise))


def weighted_mean(weights: Mapping[str, float], components: Mapping[str, Column]) -> Column:
    """Weighted mean over the components that are defined, weights rescaled to them."""
    top = bottom = F.lit(0.0)
    for name, weight in weights.items():
        value = components[name].cast("double")
        top = top + F.coalesce(F.lit(float(weight)) * value, F.lit(0.0))
        bottom = bottom + F.when(value.isNotNull(), F.lit(float(weight))).otherwise(F.lit(0.0))
    return F.try_divide(top, bottom)
