"""Date scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week(dt: Column) -> Column:
    """Day of week with Sunday = 0 (Spark's dayofweek has Sunday = 1)."""
    return (F.dayofweek(dt) - 1).cast("int")


def date_parts(dt: Column) -> list[Column]:
    """year, month, day_of_week columns of the date dimension."""
    return [F.year(dt).cast("int").alias("year"), F.month(dt).cast("int").alias("month"),
            day_of_week(dt).alias("day_of_week")]


def days_before(dt, days: int) -> Column:
    """``dt - INTERVAL 'days days'``; stays a DATE."""
    return F.date_sub(dt if isinstance(dt, Column) else F.lit(dt).cast("date"), days)


def in_dates(col: str, dates) -> Column:
    """``col`` is one of ``dates`` (any number of them: one expression, not a literal each)."""
    days = sorted({str(d) for d in dates})
    return F.expr(f"{col} IN ({', '.join(f"DATE'{d}'" for d in days)})") if days else F.lit(False)
