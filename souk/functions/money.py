"""Exact decimal arithmetic for averages and percentage drops.

Averages and ratios are computed from integer cents with half-up
(away from zero) rounding, so the stored NUMERIC(14,2) / NUMERIC(6,2)
values do not depend on intermediate decimal scales or doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT = T.DecimalType(38, 0)


def to_cents(amount: Column) -> Column:
    """A decimal amount with 2 decimals as an exact integer of cents."""
    return (amount * 100).cast(_INT)


def _floor_div(x: Column, y: Column) -> Column:
    """floor(x / y) for exact integers x >= 0 and y > 0: one integral division (with a
    remainder and a decimal quotient this took most of the time of the anomalies)."""
    return F.call_function("div", x, y).cast(_INT)


def ratio_half_up(num: Column, den: Column, scale: int, precision: int) -> Column:
    """num / den rounded half away from zero to ``scale`` decimals; NULL when den = 0."""
    n, d = num.cast(_INT), den.cast(_INT)
    factor = F.lit(10 ** scale).cast(_INT)
    q = _floor_div(F.abs(n) * factor * 2 + F.abs(d), F.abs(d) * 2)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    value = (signed * F.lit(Decimal(1).scaleb(-scale))).cast(T.DecimalType(precision, scale))
    return F.when(d != 0, value)


def moving_average(window_sum: Column, window_count: Column, precision: int = 14) -> Column:
    """AVG over a window as sum / count, rounded to cents."""
    return ratio_half_up(to_cents(window_sum), window_count * 100, 2, precision)


def drop_pct(window_sum: Column, window_count: Column, revenue: Column, precision: int = 6) -> Column:
    """100 * (avg - revenue) / avg, rounded to 2 decimals, as NUMERIC(6,2).

    With avg = S / n this is 100 * (S - n * r) / S: no intermediate average.
    """
    s, r = to_cents(window_sum), to_cents(revenue)
    return ratio_half_up((s - window_count * r) * 100, s, 2, precision)


def is_drop_anomaly(window_sum: Column, window_count: Column, revenue: Column,
                    threshold_pct) -> Column:
    """avg > 0 and 100 * (avg - r) / avg > threshold, without division."""
    s, r = to_cents(window_sum), to_cents(revenue)
    thr = F.lit(Decimal(str(threshold_pct)))
    return (window_count > 0) & (s > 0) & ((s - window_count * r) * 100 > thr * s)
