"""souk — commerce order analytics as Spark DataFrame jobs.

Layers: raw landing zone (JSON, ``dt=`` folders) -> typed staging tables ->
star schema (seller / product / customer / date dimensions + order fact) ->
daily analytics tables (top sellers, daily revenue, category split,
customer activity) -> seller revenue anomalies against a 7-day moving
average.  Every metric has a one-date form and an all-dates form.
"""

from souk.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
