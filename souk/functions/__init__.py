"""Column-level helpers: date parts, exact money arithmetic, ratios, filters."""

from souk.functions.dates import date_parts, day_of_week, days_before
from souk.functions.money import (drop_pct, is_drop_anomaly, moving_average, ratio_half_up,
                                  to_cents)
from souk.functions.predicates import (active_ratio, not_cancelled, status_not_in)

__all__ = [
    "date_parts", "day_of_week", "days_before", "drop_pct", "is_drop_anomaly", "moving_average",
    "ratio_half_up", "to_cents", "active_ratio", "not_cancelled", "status_not_in",
]
