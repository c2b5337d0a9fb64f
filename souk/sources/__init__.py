"""Sources: the benchmark-table mapping, the raw landing zone and table scans."""
