"""Named plans: the query catalog and its DuckDB oracle statements."""
