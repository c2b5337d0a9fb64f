"""Table operators: joins, metrics, anomalies, quality rules, star schema, sinks, reads."""
