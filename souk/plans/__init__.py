"""Composite jobs (ingest, star build, aggregates, anomalies) and the query catalog."""
