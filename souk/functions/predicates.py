"""Row predicates and small ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from souk.schemas import EXCLUDED_STATUS, STATUSES


def not_cancelled(status: Column | str = "status") -> Column:
    """``status != 'cancelled'``: NULL status is dropped (three-valued logic)."""
    return F.col(status) != EXCLUDED_STATUS if isinstance(status, str) else status != EXCLUDED_STATUS


def status_not_in(status: Column | str = "status", allowed=STATUSES) -> Column:
    """``status NOT IN (...)``: NULL status is not counted."""
    c = F.col(status) if isinstance(status, str) else status
    return ~c.isin(*allowed)


def active_ratio(active: Column, dormant: Column) -> Column:
    """active / max(active + dormant, 1) as a double."""
    return active.cast("double") / F.greatest(active + dormant, F.lit(1)).cast("double")
