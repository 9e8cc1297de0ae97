"""Row-level money columns: sign, flat currency factors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlens.functions import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def signed_amount(amount, category, income_categories) -> Column:
    """Spending negative, income operations positive."""
    return F.when(_c(category).isin(*income_categories), F.abs(_c(amount))).otherwise(-_c(amount))


def flat_factor(currency, factors: dict | None = None) -> Column:
    """Flat factor into US dollars for exotic currencies, NULL otherwise."""
    factors = K.TO_USD_FACTORS if factors is None else factors
    expr = None
    for code, f in factors.items():
        expr = (F.when(_c(currency) == code, F.lit(float(f))) if expr is None
                else expr.when(_c(currency) == code, F.lit(float(f))))
    return expr if expr is not None else F.lit(None).cast("double")


def flat_converted(amount, currency, factors: dict | None = None) -> tuple[Column, Column]:
    """(amount, currency) after the flat step: exotic amounts are multiplied
    by their factor and then count as US dollars; others pass unchanged."""
    f = flat_factor(currency, factors)
    amt = F.when(f.isNotNull(), _c(amount).cast("double") * f).otherwise(_c(amount).cast("double"))
    cur = F.when(f.isNotNull(), F.lit(K.USD_CODE)).otherwise(_c(currency))
    return amt, cur
