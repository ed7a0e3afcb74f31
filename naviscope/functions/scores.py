"""The five scheme scores, their mean and the label."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def risk_score(code) -> Column:
    return F.col(code) / F.lit(5.0)


def rating_score(rating) -> Column:
    return F.coalesce(F.col(rating) / F.lit(5.0), F.lit(0.0))


def allocation_ratio(scheme_aum, family_aum) -> Column:
    """Scheme assets against the rest of the family; null where undefined."""
    return F.try_divide(F.col(scheme_aum), F.col(family_aum) - F.col(scheme_aum))


def beats_category(diff) -> Column:
    return F.when(F.col(diff) > 0, 1.0).otherwise(0.0)


def volatility_ratio(worst, best) -> Column:
    """Worst over best of the category; null where a zero or null best undoes it."""
    return F.when(
        F.col(worst) > 0, F.try_divide(F.col(worst), F.col(best))
    ).otherwise(0.0)


def mean_of(*names) -> Column:
    """Row-wise mean, added in the order given."""
    total = F.col(names[0])
    for name in names[1:]:
        total = total + F.col(name)
    return total / F.lit(float(len(names)))


def half_up(x) -> Column:
    """Round to a whole number, halves away from zero."""
    return F.round(x, 0)
