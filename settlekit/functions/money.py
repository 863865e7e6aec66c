"""Exact money and ratio expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from settlekit.schemas import FX_RATE, FX_RATES_TO_EUR, MONEY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fx_rate(currency) -> Column:
    """EUR rate of a currency as DECIMAL(5,3); NULL for an unknown currency.

    A CASE chain folds to a constant lookup; for thousands of currencies use a
    broadcast join to a rate table instead (a rate table is bounded by the
    number of ISO currencies).
    """
    cur = _col(currency)
    expr = None
    for code, rate in FX_RATES_TO_EUR.items():
        lit_rate = F.lit(rate).cast(FX_RATE)
        expr = F.when(cur == code, lit_rate) if expr is None else expr.when(cur == code, lit_rate)
    return expr.otherwise(F.lit(None).cast(FX_RATE))


def to_eur(amount, currency) -> Column:
    """``round(amount * rate, 2)`` in decimals (half up) as DECIMAL(15,2).

    NULL for an unknown currency and for a result beyond DECIMAL(15,2).
    """
    return F.round(_col(amount).try_cast(MONEY) * fx_rate(currency), 2).try_cast(MONEY)


def safe_ratio(numerator, denominator, digits: int = 4) -> Column:
    """``round(n / d, digits)`` as double, 0 when ``d`` is not positive.

    For integral counts the double quotient rounds exactly half up.
    """
    n, d = _col(numerator), _col(denominator)
    return F.round(F.when(d > 0, n.cast("double") / d).otherwise(F.lit(0.0)), digits)


def half_up_quotient(numerator, denominator, digits: int) -> Column:
    """Exact ``numerator / denominator`` rounded half away from zero.

    ``numerator`` integral (any sign), ``denominator`` a positive integer.
    Computed in integers, so no double rounding; returned as DECIMAL(38, digits).
    """
    n, d = _col(numerator).cast("decimal(38,0)"), _col(denominator).cast("decimal(38,0)")
    scale = F.lit(10 ** digits).cast("decimal(38,0)")
    mag = (F.abs(n) * scale * 2 + d).cast("decimal(38,0)")
    two_d = (d * 2).cast("decimal(38,0)")
    # mag - mag % 2d is a multiple of 2d: the decimal division is exact.
    q = ((mag - mag % two_d) / two_d).cast("decimal(38,0)")
    unit = F.lit("1e-%d" % digits).cast("decimal(%d,%d)" % (digits + 1, digits)) if digits else F.lit(1)
    return (F.signum(n).cast("decimal(1,0)") * q * unit).cast("decimal(38,%d)" % digits)


def money_avg(amount_sum, count) -> Column:
    """Half-up average of a DECIMAL(.,2) sum over ``count`` rows, DECIMAL(15,2).

    Works on the unscaled cent sum so the result is exact for any group size
    (avg() on decimals rounds twice: to 6 digits, then to 2).
    """
    n = _col(count)
    cents = (_col(amount_sum) * 100).cast("decimal(38,0)")
    # cents / (100 n) = euros, rounded once to the cent
    return F.when(n > 0, half_up_quotient(cents, n * 100, 2)).cast(MONEY)
